"""Supervoxels of slices: every slice flooded over its boundaries from seeds of its own, whatever blocks it crosses."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.operators import labels, seeds
from stratovox.operators.distances import distance_transform
from stratovox.operators.kernels import flooded
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES

#: Cells of a stack of slices.
CELLS = 1 << 18
METHODS = ("grid", "minima", "maxima_distance")


def slice_seeds(volume: DataFrame, boundary: str, method: str = "maxima_distance", spacing: int = 10, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, seed`` of each slice: a ``grid`` of single voxels, the regional ``minima`` of the boundary, or the regional maxima of the distance to
    boundaries of one half or more (``maxima_distance``). Seeds are named by their first voxel's linear index plus 1."""
    if method == "grid":
        rows = volume.where((F.col("y") % spacing == 0) & (F.col("x") % spacing == 0)).select(*AXES)
        return labels.linear_index(rows, size or _size(volume)).withColumnRenamed("index_", "seed")
    if method == "minima":
        return seeds.regional_extrema(volume, boundary, True, ("y", "x"), size or _size(volume))
    if method != "maxima_distance":
        raise ValueError(f"unknown method {method}")
    far = distance_transform(volume, F.col(boundary) < 0.5, axes=("y", "x"))
    return seeds.regional_extrema(saved(far, "distances"), "distance", False, ("y", "x"), size or _size(volume))


def _size(volume: DataFrame) -> tuple[int, int]:
    found = volume.agg(F.max("y").alias("y"), F.max("x").alias("x")).first()
    return ((found.y or 0) + 1, (found.x or 0) + 1)


def _stacks(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Whole slices, in order, flooded in stacks of at most ``CELLS`` cells (or one slice), each slice within its own bounding box."""
    z, y, x, height, seed = (table.column(c).to_numpy() for c in (*AXES, "h_", "seed"))
    slices, at = np.unique(z, return_inverse=True)
    per = max(1, CELLS // (int(np.ptp(y) + 1) * int(np.ptp(x) + 1)))
    for first in range(0, len(slices), per):
        a, b = np.searchsorted(at, [first, first + per])
        k, spans = at[a:b] - first, []
        starts = np.searchsorted(k, np.arange(k[-1] + 1))
        place = [k]
        for c in (y[a:b], x[a:b]):
            c = c - c.min()
            place.append(c)
            every = np.arange(c.max() + 1)
            spans.append((every >= np.minimum.reduceat(c, starts)[:, None]) & (every <= np.maximum.reduceat(c, starts)[:, None]))
        inside, place = spans[0][:, :, None] & spans[1][:, None, :], tuple(place)
        level, marks = np.full(inside.shape, np.finfo(np.float64).max), np.zeros(inside.shape, np.int64)
        level[place], marks[place] = height[a:b], seed[a:b]
        found = pa.array(flooded(level, marks, (1, 2), inside)[place])
        yield from pa.Table.from_arrays([*(table.column(c).slice(a, b - a) for c in AXES), found], names=[*AXES, "id"]).to_batches(max_chunksize=1 << 16)


def _flooded_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, enough = [], 0, CELLS
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < enough:
            continue
        table = pa.Table.from_batches(held)
        z = table.column("z").to_numpy()
        cut = int(np.searchsorted(z, z[-1]))  # the last slice may go on
        if cut:
            yield from _stacks(table.slice(0, cut))
        held, size = table.slice(cut).to_batches(), size - cut
        enough = max(CELLS, 2 * size)
    if size:
        yield from _stacks(pa.Table.from_batches(held))


def slice_supervoxels(volume: DataFrame, boundary: str, method: str = "maxima_distance", spacing: int = 10, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, id`` of every voxel with a row: its seed in the slice by the lowest path over ``boundary``; ids go on from slice to slice, from 1.

    A task floods whole slices, many small ones at once. Voxels without a row are as high as can be.
    """
    found = slice_seeds(volume, boundary, method, spacing, size)
    rows = volume.select(*(F.col(a).cast("int").alias(a) for a in AXES), F.col(boundary).cast("double").alias("h_")).join(found.hint("merge"), list(AXES), "left").select(*AXES, "h_", F.coalesce("seed", F.lit(0)).cast("long").alias("seed"))

    flood = rows.repartition("z").sortWithinPartitions("z").mapInArrow(_flooded_slices, "z int, y int, x int, id long")
    return labels.compacted(saved(flood, "supervoxels"), "id")
