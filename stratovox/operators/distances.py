"""Exact distances over a whole volume, axis by axis.

The squared distance to the nearest voxel of another label is found along x, then y, then z: along a line, each stretch
of one label takes the lower envelope of parabolas that stand on the distances found so far, and the voxels next to the
stretch stand for all of another label that lie behind them. A pass deals the lines to tasks, which handle thousands at
once as arrays, step by step along the line; lengths of lines are bounded by the volume's extent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators.quantiles import exact_quantiles
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES, dense

#: Cells of the matrices that a task works on at once.
CELLS = 1 << 21


def lower_envelope(f: np.ndarray, step: float) -> np.ndarray:
    """For each row, the least of ``f[p] + (step * (q - p)) ** 2`` over all p, at every q; infinite where the row has no finite value."""
    lines, n = f.shape
    w = step * step
    foot = np.zeros((lines, n), np.int64)
    since = np.full((lines, n), -np.inf)  # where a parabola becomes the lowest
    top = np.full(lines, -1)
    for q in range(n):
        rows = np.flatnonzero(np.isfinite(f[:, q]))
        meet = np.full(lines, -np.inf)
        open_ = rows[top[rows] >= 0]
        while len(open_):
            k = top[open_]
            p = foot[open_, k]
            meet[open_] = ((f[open_, q] + w * q * q) - (f[open_, p] + w * p * p)) / (2 * w * (q - p))
            hidden = meet[open_] <= since[open_, k]
            top[open_[hidden]] -= 1
            open_ = open_[hidden]
        top[rows] += 1
        foot[rows, top[rows]], since[rows, top[rows]] = q, meet[rows]
    out, k, every = np.full((lines, n), np.inf), np.zeros(lines, np.int64), np.arange(lines)
    filled = top >= 0
    for q in range(n):
        while True:
            on = (k < top) & (since[every, np.minimum(k + 1, n - 1)] < q)
            if not on.any():
                break
            k[on] += 1
        p = foot[every, k]
        out[:, q] = np.where(filled, f[every, p] + w * (q - p) ** 2, np.inf)
    return out


def along_lines(label: np.ndarray, f: np.ndarray, step: float) -> np.ndarray:
    """One axis' pass over lines (rows) of labels and squared distances; 0 where the label is 0."""
    lines, n = label.shape
    out = np.zeros((lines, n))
    change = np.ones((lines, n), bool)
    change[:, 1:] = label[:, 1:] != label[:, :-1]
    row, start = np.nonzero(change)
    stop = np.append(start[1:], n)
    stop[np.append(row[1:] != row[:-1], True)] = n
    inside = label[row, start] != 0
    row, start, stop = row[inside], start[inside], stop[inside]
    size = stop - start
    # stretches of like lengths together, a matrix column for each voxel and for its two neighbours outside: cells grow with the voxels, not with lines by stretches
    kind = np.ceil(np.log2(size + 2)).astype(np.int64)
    order = np.argsort(kind, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
        per = max(1, CELLS >> int(kind[same[0]])) if len(same) else 1
        for i in range(0, len(same), per):
            r, a, b, k = (v[same[i : i + per], None] for v in (row, start, stop, size))
            width = int(k.max())
            place = a + np.arange(width)
            own = place < b
            values = np.full((len(r), width + 2), np.inf)
            values[:, 1:-1][own] = f[np.broadcast_to(r, own.shape)[own], place[own]]
            values[a[:, 0] > 0, 0] = 0.0
            ends = np.flatnonzero(b[:, 0] < n)
            values[ends, k[ends, 0] + 1] = 0.0
            out[np.broadcast_to(r, own.shape)[own], place[own]] = lower_envelope(values, step)[:, 1:-1][own]
    return out


def _pass(rows: DataFrame, axis: str, n: int, step: float) -> DataFrame:
    others = [a for a in AXES if a != axis]
    names = [*others, axis, "l", "d"]

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, whole = 0, max(1, CELLS // n) * n

        def out(table: pa.Table):
            label = table.column("l").to_numpy().reshape(-1, n)
            found = along_lines(label, table.column("d").to_numpy().reshape(-1, n), step)
            done = table.set_column(4, "d", pa.array(found.reshape(-1)))
            yield from done.to_batches(max_chunksize=1 << 16)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= whole:
                table = pa.Table.from_batches(held)
                cut = size // n * n
                yield from out(table.slice(0, cut).combine_chunks())
                held, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield from out(pa.Table.from_batches(held).combine_chunks())

    dealt = rows.select(*names).repartition(*others).sortWithinPartitions(*others, axis)
    return dealt.mapInArrow(run, "{} int, {} int, {} int, l long, d double".format(*others, axis))


def squared_distances(volume: DataFrame, label: str | Column, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0),
                      low: tuple[int, ...] | None = None, high: tuple[int, ...] | None = None, axes: tuple[str, ...] = AXES) -> DataFrame:
    """``z, y, x, d``: squared distance of every labelled voxel to the nearest voxel of another label, background included; 0 for background, infinite
    if all the volume has one label.

    The volume is the box [low, high), by default the bounding box of its rows; its missing rows, and null labels, are background. What lies outside of
    it is no voxel. ``label`` is a whole number or true and false. ``axes``: those along which distances are taken (``("y", "x")``: slice by slice).
    """
    value = F.col(label) if isinstance(label, str) else label
    rows = volume.select(*(F.col(a).cast("int").alias(a) for a in AXES), F.coalesce(value.cast("long"), F.lit(0)).alias("l"))
    rows = saved(dense(rows, low, high), "labels")
    ends = rows.agg(*(f(a).alias(f"{k}{a}") for a in AXES for k, f in (("low", F.min), ("high", F.max)))).first()
    if ends["lowz"] is None:
        return rows.select(*AXES, F.lit(0.0).alias("d"))
    found = rows.withColumn("d", F.lit(float("inf")))
    for axis in (a for a in AXES[::-1] if a in axes):
        found = _pass(found, axis, ends[f"high{axis}"] - ends[f"low{axis}"] + 1, float(spacing[AXES.index(axis)]))
    return found.select(*AXES, "d")


def distance_transform(volume: DataFrame, label: str | Column, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0), low: tuple[int, ...] | None = None,
                       high: tuple[int, ...] | None = None, axes: tuple[str, ...] = AXES) -> DataFrame:
    """``z, y, x, distance``, as :func:`squared_distances`; -1 where there is no voxel of another label."""
    found = squared_distances(volume, label, spacing, low, high, axes)
    return found.select(*AXES, F.when(F.col("d") == float("inf"), F.lit(-1.0)).otherwise(F.sqrt("d")).alias("distance"))


def object_energy(volume: DataFrame, label: str, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0), background: float = -1.0) -> DataFrame:
    """``z, y, x, energy``: the distance to the border of the own object, as a share of the object's greatest (1 where it has no border);
    ``background`` outside of objects."""
    rows = saved(distance_transform(volume, label, spacing), "distances").join(volume.select(*AXES, F.col(label).alias("l_")).hint("merge"), list(AXES), "left")
    inside = rows.where("l_ <> 0")
    most = inside.groupBy("l_").agg(F.max("distance").alias("most_"))
    share = F.when(F.col("distance") < 0, F.lit(1.0)).otherwise(F.col("distance") / F.col("most_"))
    out = inside.join(most, "l_").select(*AXES, share.alias("energy"))
    return out.unionByName(rows.where("l_ is null or l_ = 0").select(*AXES, F.lit(float(background)).alias("energy")))


def side_distances(volume: DataFrame, a: Column, b: Column, spacing: tuple[float, float, float], far: float = 200.0) -> DataFrame:
    """How far two sets of voxels are from each other: ``side`` (0: from ``a`` to the nearest of ``b``; 1: the other way), ``mean, std, most, median, n`` and how
    many are farther than ``far``. Voxels without a row are in neither set. A side without voxels, or without an opposite, gives no row."""
    rows, out = saved(dense(volume.select(*AXES, *(F.coalesce(c, F.lit(False)).alias(n) for c, n in ((a, "a_"), (b, "b_"))))), "sides"), []
    for side, (own, other) in enumerate((("a_", "b_"), ("b_", "a_"))):
        outside = F.when(F.col(other), F.lit(0)).otherwise(F.lit(1))
        found = distance_transform(rows, outside, spacing).join(rows.where(own).select(*AXES).hint("merge"), list(AXES)).where("distance >= 0")
        found = saved(found.select("distance"), "distances")
        middle = exact_quantiles(found, "distance", [0.5])
        if not middle:
            continue
        d = F.col("distance")
        out.append(found.agg(F.lit(side).alias("side"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std"), F.max(d).alias("most"), F.lit(middle[0]).alias("median"),
                             F.count("*").alias("n"), F.count(F.when(d > far, 1)).alias("far")))
    if not out:
        return volume.sparkSession.createDataFrame([], "side int, mean double, std double, most double, median double, n long, far long")
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])
