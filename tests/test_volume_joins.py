"""Joins of voxel tables never broadcast, and stacks of slices flood as single slices do."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stratovox.operators import dispatch, supervoxels
from stratovox.operators.kernels import flooded
from tests.test_whole_volumes import frame


def test_object_distances_broadcast_no_voxels(spark):
    rows = frame(spark, {p: (1 + p[2] // 3,) for p in np.ndindex(2, 6, 7)}, "l long")
    plan = dispatch.object_distance(rows, "l")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_stacks_of_slices_flood_as_single_slices(monkeypatch):
    """Slices with holes and boxes of their own; four of them are flooded at once."""
    calls = []
    monkeypatch.setattr(supervoxels, "flooded", lambda *a: calls.append(a) or flooded(*a))
    r = np.random.default_rng(3)
    rows, want = [], {}
    for z in (3, 4, 7, 9):
        shape = tuple(r.integers(3, 9, 2))
        height, marks = np.round(r.random(shape), 1), np.zeros(shape, np.int64)
        level = np.full(shape, np.finfo(np.float64).max)
        for k in range(1, 4):
            marks[tuple(r.integers(0, shape))] = 100 * z + k
        there = (r.random(shape) < 0.7) | (marks > 0)
        there[0, 0] = there[-1, -1] = True
        level[there] = height[there]
        found = flooded(level, marks)
        for y, x in np.argwhere(there).tolist():
            rows.append((z, y + z, x + 2 * z, height[y, x], marks[y, x]))
            want[z, y + z, x + 2 * z] = found[y, x]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(),) * 3 + (pa.float64(), pa.int64()))], names=["z", "y", "x", "h_", "seed"])

    def run():
        return {(z, y, x): i for b in supervoxels._flooded_slices(table.to_batches(max_chunksize=10)) for z, y, x, i in zip(*(c.to_pylist() for c in b.columns))}

    assert run() == want and len(calls) == 1
    monkeypatch.setattr(supervoxels, "CELLS", 30)
    assert run() == want
