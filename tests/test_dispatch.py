"""Targets by options against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from stratovox.operators import decoders, dispatch, objects, stencils, targets
from tests.test_operators import as_dict

SHAPE = (2, 7, 9)


@pytest.fixture(scope="module")
def labels(spark):
    r = random.Random(6)
    a = np.zeros(SHAPE, int)
    a[:, 1:5, 1:4], a[:, 1:6, 4:8], a[1, 0, 0], a[0, 5:7, 0:2] = 1, 2, 3, 4
    a[0, 3, 5] = a[1, 2, 2] = 0
    for _ in range(4):
        a[r.randrange(2), r.randrange(7), r.randrange(9)] = 2
    rows = [(*map(int, p), int(a[p])) for p in np.ndindex(SHAPE) if a[p]] + [(1, 6, 8, 0)]
    return a, spark.createDataFrame(rows, "z int, y int, x int, l long")


def channel(found, k=0):
    return as_dict(found.where(f"channel = {k}"), "value")


def distance_to(points, p, spacing=(1, 1, 1)):
    return min((math.sqrt(sum(((a - b) * s) ** 2 for a, b, s in zip(p, q, spacing))) for q in points), default=None)


def test_simple_options(labels):
    a, v = labels
    assert channel(dispatch.one_target(v, "l", "0-2-4")) == {p: float(a[p] in (2, 4)) for p in np.ndindex(SHAPE)}
    assert channel(dispatch.one_target(v, "l", "9")) == {p: float(a[p]) for p in np.ndindex(SHAPE)}
    found = dispatch.one_target(v, "l", "2-1-2-2-v1")
    want = targets.affinities(v, "l", "2-1-2-2-v1")
    for k, axis in enumerate("zyx"):
        assert channel(found, k) == as_dict(want, f"aff_{axis}")
    with pytest.raises(ValueError):
        dispatch.one_target(v, "l", "x")
    with pytest.raises(ValueError):
        dispatch.one_target(v, "l", "5-2d-0-0-1.0-2")


def test_contours(labels):
    a, v = labels
    assert channel(dispatch.one_target(v, "l", "4-1-1")) == as_dict(stencils.boundaries(v, "l", 1), "boundary")
    got = channel(dispatch.one_target(v, "l", "4-1-0"))
    for z, y, x in np.ndindex(SHAPE):
        box = a[z, max(y - 1, 0) : y + 2, max(x - 1, 0) : x + 2]
        assert got[z, y, x] == float(len(set(box[box > 0].tolist())) > 1)


def test_small_parts_by_axis(labels):
    a, v = labels
    got = channel(dispatch.one_target(v, "l", "3-8-2-1"))
    want = np.zeros(SHAPE, bool)
    for axis in range(3):
        for k in range(SHAPE[axis]):
            part = np.take(a, k, axis)
            for label in np.unique(part[part > 0]):
                marks = decoders.numbered(part == label)
                small = np.bincount(marks.ravel())[marks] < (8 if axis == 0 else 4)
                place = [slice(None)] * 3
                place[axis] = k
                want[tuple(place)] |= (marks > 0) & small
    assert got == {p: float(want[p]) for p in np.ndindex(SHAPE)}


@pytest.mark.parametrize("mode, padding, levels", [("2d", 0, 0), ("2d", 1, 0), ("3d", 0, 0), ("3d", 1, 1)])
def test_object_distances(labels, mode, padding, levels):
    a, v = labels
    got = channel(dispatch.one_target(v, "l", f"5-{mode}-{padding}-{levels}-2.0-0"))
    spacing = (1, 1, 1) if mode == "2d" else (2, 1, 1)
    parts = np.zeros(SHAPE, int)
    for label in (1, 2, 3, 4):
        if mode == "2d":
            for z in range(2):
                marks = decoders.numbered(a[z] == label)
                parts[z] += np.where(marks > 0, marks + 1000 * label + 100 * z, 0)
        else:
            marks = decoders.numbered(a == label)
            parts += np.where(marks > 0, marks + 1000 * label, 0)
    wide = np.pad(parts, [(0 if mode == "2d" else 1,) * 2, (1, 1), (1, 1)]) if padding else parts
    shift = [(w - n) // 2 for w, n in zip(wide.shape, SHAPE)]
    d = {}
    for p in np.ndindex(SHAPE):
        if parts[p]:
            at = tuple(k + s for k, s in zip(p, shift))
            other = [q for q in np.ndindex(wide.shape) if wide[q] != parts[p] and (mode == "3d" or q[0] == at[0])]
            d[p] = distance_to(other, at, spacing)
    for p in np.ndindex(SHAPE):
        energy = d[p] / (max(v for q, v in d.items() if parts[q] == parts[p]) + 1e-6) if parts[p] else -1.0
        if levels:
            energy = 0 if energy < 0 else min(int(energy * 10) + 1, 10)
        assert got[p] == pytest.approx(energy)


@pytest.mark.parametrize("mode", ["2d", "3d"])
def test_semantic_distances(spark, labels, mode):
    a, v = labels
    got = channel(dispatch.one_target(v, "l", f"6-{mode}-4-20"))
    for p in np.ndindex(SHAPE):
        same = [q for q in np.ndindex(SHAPE) if mode == "3d" or q[0] == p[0]]
        away = distance_to([q for q in same if (a[q] > 0) != (a[p] > 0)], p, (6, 1, 1) if mode == "3d" else (1, 1, 1))
        assert got[p] == pytest.approx(math.tanh(away / 4 if a[p] else -away / 20))
    full = spark.createDataFrame([(0, y, x, 1) for y in range(2) for x in range(2)], "z int, y int, x int, l long")
    assert set(channel(dispatch.one_target(full, "l", "6")).values()) == {math.tanh(5.0)}


def test_flows_and_grown_labels(labels):
    a, v = labels
    found = dispatch.one_target(v, "l", "7-0")
    flow = {(r.z, r.y, r.x): (r.dy, r.dx) for r in objects.flows(v, "l").collect()}
    assert channel(found, 2) == {p: float(a[p] > 0) for p in np.ndindex(SHAPE)}
    dy, dx = channel(found, 0), channel(found, 1)
    assert all((dy[p], dx[p]) == pytest.approx(flow.get(p, (0.0, 0.0))) for p in np.ndindex(SHAPE))
    got = channel(dispatch.one_target(v, "l", "8-3-2d-0-0-1.0-0"))
    for z, y, x in np.ndindex(SHAPE):
        grown = a[max(z - 1, 0) : z + 2, max(y - 1, 0) : y + 2, max(x - 1, 0) : x + 2].max() > 0
        assert (got[z, y, x] > 0) == grown


def test_all_in_one_table(labels):
    _, v = labels
    found = dispatch.to_targets(v, "l", ["0", "1", "2"])
    assert {(r.target, r.channel): r.n for r in found.groupBy("target", "channel").agg({"value": "count"}).withColumnRenamed("count(value)", "n").collect()} == {k: 126 for k in [(0, 0), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2)]}
    assert dispatch.to_targets(v.limit(0), "l", ["0", "9"]).count() == 0
