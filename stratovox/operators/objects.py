"""Targets that are made object by object within slices: weights between neighbours, and flows towards an object's centre."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.operators.stencils import before
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES, dense

FAR = np.iinfo(np.int64).max // 4
#: Cells of the lines that a task works on at once.
CELLS = 1 << 20


def two_nearest(label: np.ndarray, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One axis' pass: labels and squared distances (whole numbers) of the two nearest objects of each cell; both arrays are (2, lines, cells).

    What a cell needs from another one of its line are its two nearest objects at most, so two are carried. Cells look ever farther along the
    line, and stop as soon as nothing there can be nearer than the second object of any cell.
    """
    n = label.shape[2]
    best, near = label.copy(), squared.copy()
    for gap in range(1, n):
        if gap * gap >= near[1].max():
            break
        for own, other in ((slice(gap, None), slice(None, -gap)), (slice(None, -gap), slice(gap, None))):
            for k in range(2):
                l, d = label[k][:, other], np.minimum(squared[k][:, other] + gap * gap, FAR)
                l1, d1, l2, d2 = best[0][:, own], near[0][:, own], best[1][:, own], near[1][:, own]
                known = (l > 0) & (d < FAR)
                first = known & (d < d1)
                shift = first & (l != l1)
                l2[shift], d2[shift] = l1[shift], d1[shift]
                l1[first], d1[first] = l[first], d[first]
                second = known & ~first & (l != l1) & (d < d2)
                l2[second], d2[second] = l[second], d[second]
    return best, near


def nearest_objects(volume: DataFrame, label: str) -> DataFrame:
    """``z, y, x, first, second``: distances of every voxel to the two nearest objects of its slice (0 inside an object); null if there are fewer.

    A row for every voxel of the bounding box; missing rows are background.
    """
    rows = saved(dense(volume.select(*(F.col(a).cast("int").alias(a) for a in AXES), F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("l"))), "labels")
    ends = rows.agg(*(f(a).alias(f"{k}{a}") for a in ("y", "x") for k, f in (("low", F.min), ("high", F.max)))).first()
    found = rows.select(*AXES, F.col("l").alias("l1"), F.when(F.col("l") != 0, 0).otherwise(FAR).cast("long").alias("d1"), F.lit(0).cast("long").alias("l2"), F.lit(FAR).cast("long").alias("d2"))
    if ends["lowy"] is not None:
        for a in ("x", "y"):
            found = _lines(found, a, ends[f"high{a}"] - ends[f"low{a}"] + 1)
    distance = lambda k: F.when(F.col(f"d{k}") < FAR, F.sqrt(F.col(f"d{k}").cast("double")))
    return found.select(*AXES, distance(1).alias("first"), distance(2).alias("second"))


def _lines(rows: DataFrame, axis: str, n: int) -> DataFrame:
    others = [a for a in AXES if a != axis]

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, whole = 0, max(1, CELLS // n) * n

        def out(table: pa.Table):
            stack = lambda c: np.stack([table.column(f"{c}{k}").to_numpy().reshape(-1, n) for k in (1, 2)])
            best, near = two_nearest(stack("l"), stack("d"))
            columns = [*table.columns[:3], *(pa.array(x[k].reshape(-1)) for k in range(2) for x in (best, near))]
            yield from pa.Table.from_arrays(columns, names=[*others, axis, "l1", "d1", "l2", "d2"]).to_batches(max_chunksize=1 << 16)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= whole:
                table, cut = pa.Table.from_batches(held), size // n * n
                yield from out(table.slice(0, cut).combine_chunks())
                held, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield from out(pa.Table.from_batches(held).combine_chunks())

    dealt = rows.select(*others, axis, "l1", "d1", "l2", "d2").repartition(*others).sortWithinPartitions(*others, axis)
    return dealt.mapInArrow(run, "{} int, {} int, {} int, l1 long, d1 long, l2 long, d2 long".format(*others, axis))


def border_weights(volume: DataFrame, label: str, w0: float = 10.0, w1: float = 5.0, sigma: float = 5.0) -> DataFrame:
    """``z, y, x, weight``: ``w1`` inside objects; between objects ``w0`` times a bell of the sum of both distances; 1 at least, and 1 outside in slices of
    fewer than two objects."""
    objects = dense(volume.select(*AXES, F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("l_")))
    rows = nearest_objects(objects, "l_")
    total = F.col("first") + F.col("second")
    between = F.coalesce(w0 * F.exp(-(total * total) / (2 * sigma * sigma)), F.lit(1.0))
    weight = F.when(F.col("first") == 0, F.lit(float(w1))).otherwise(between)
    return rows.select(*AXES, F.least(F.greatest(weight, F.lit(1.0)), F.lit(float(max(w0, w1)))).alias("weight"))


def spread(y: np.ndarray, x: np.ndarray, rounds: int) -> np.ndarray:
    """The density of an object's cells that spreads from its centre in so many rounds.

    Every round the centre gains one, and each cell takes the mean over its 3 by 3 box, the object's cells alone counting. The centre is the
    first cell (by row) that is nearest to the medians.
    """
    order = np.lexsort((x, y))
    yo, xo = y[order], x[order]
    middle = order[np.argmin((xo - np.median(x)) ** 2 + (yo - np.median(y)) ** 2)]
    py, px = y - y.min() + 1, x - x.min() + 1
    inside = np.zeros((py.max() + 2, px.max() + 2))
    inside[py, px] = 1.0
    heat = np.zeros_like(inside)
    for _ in range(rounds):
        heat[py[middle], px[middle]] += 1
        rows = heat[:-2] + heat[1:-1] + heat[2:]
        heat[1:-1, 1:-1] = (rows[:, :-2] + rows[:, 1:-1] + rows[:, 2:]) / 9 * inside[1:-1, 1:-1]
    return heat[py, px]


def flows(volume: DataFrame, label: str) -> DataFrame:
    """``z, y, x, dy, dx`` of every labelled voxel: unit vectors up the logarithm of the density that spreads from its object's centre in the slice.

    A task spreads one object of one slice at a time, whatever blocks it crosses; all objects of a slice take as many rounds as its largest needs
    (twice the sum of the sides of its box, counted with one more each). Directions are differences across the voxel in the whole slice: a
    neighbour of another object counts with that object's density, background with none.
    """
    rows = volume.where(F.col(label) != 0).select(*(F.col(a).cast("int").alias(a) for a in AXES), F.col(label).cast("long").alias("l_"))
    sides = rows.groupBy("z", "l_").agg(sum((F.max(a) - F.min(a) + 2 for a in ("y", "x")), F.lit(0)).alias("s_"))
    rounds = sides.groupBy("z").agg((2 * F.max("s_")).cast("int").alias("rounds_"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        return part[list(AXES)].assign(h=np.log1p(spread(part["y"].to_numpy(), part["x"].to_numpy(), int(part["rounds_"].iloc[0]))))

    height = rows.join(rounds, "z").groupBy("z", "l_").applyInPandas(run, "z int, y int, x int, h double")
    up = {a: F.coalesce(before("h", a, -1), F.lit(0.0)) - F.coalesce(before("h", a, 1), F.lit(0.0)) for a in ("y", "x")}
    steep = height.select(*AXES, up["y"].alias("dy"), up["x"].alias("dx"))
    size = F.lit(1e-20) + F.sqrt(F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx"))
    return steep.select(*AXES, (F.col("dy") / size).alias("dy"), (F.col("dx") / size).alias("dx"))
