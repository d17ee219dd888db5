"""Distances to the nearest of many chosen vectors, and the farthest part of the rest.

Both sides are dealt to a grid of tiles, so a task holds a bounded part of each: every row goes to all tiles of its row or column of the grid,
a tile is compared by matrix products, and an aggregation takes the least. Nothing passes through the driver but two counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratovox.operators.grid import running_before
from stratovox.plans.scratch import saved

#: Rows of a tile on the side that asks and on the chosen side, about; and cells of a matrix product.
ASKED = 1 << 15
CHOSEN = 1 << 13
CELLS = 1 << 22


def nearest_distances(asked: DataFrame, chosen: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, d``: the squared distance of each asked vector to the nearest chosen one. Vectors are arrays of doubles of one length; rows without a
    vector, or all of them if nothing is chosen, are left out; rows that share a key give one row, with the least distance."""
    sides = {}
    for name, rows in (("asked", asked), ("chosen", chosen)):
        sides[name] = saved(rows.where(F.col(vector).isNotNull()).select(F.col(key).alias("key_"), F.col(vector).alias("v_"), F.xxhash64(F.monotonically_increasing_id()).alias("r_")), name)
    down, across = (max(1, -(-sides[n].count() // size)) for n, size in (("asked", ASKED), ("chosen", CHOSEN)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = sides["asked"].select("key_", "v_", F.pmod("r_", F.lit(down)).cast("int").alias("i"), every(across).alias("j"))
    right = sides["chosen"].select("v_", every(down).alias("i"), F.pmod("r_", F.lit(across)).cast("int").alias("j"))

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return pa.table({"key_": a.column("key_").slice(0, 0), "d": pa.array([], pa.float64())})
        u, v = (t.column("v_").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1) for t in (a, b))
        square, out = (v * v).sum(axis=1), np.empty(len(u))
        step = max(1, CELLS // len(v))
        for k in range(0, len(u), step):
            part = u[k : k + step]
            near = np.argmin(square - 2 * (part @ v.T), axis=1)
            out[k : k + step] = ((part - v[near]) ** 2).sum(axis=1)
        return pa.table({"key_": a.column("key_"), "d": pa.array(out)})

    kind = dict(sides["asked"].dtypes)["key_"]
    tiles = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(nearest, f"key_ {kind}, d double")
    return tiles.groupBy(F.col("key_").alias(key)).agg(F.min("d").alias("d"))


def farthest(distances: DataFrame, key: str, distance: str, one_in: int, bins_each: int = 1000) -> DataFrame:
    """The rows of the greatest distances, one in ``one_in`` of all (floored); ties go by the lesser key.

    Ranks are running counts over bins of the distance, then places inside a bin, so no task sorts all rows.
    """
    binned = distances.withColumn("bin", F.floor(-F.col(distance) * bins_each))
    bins = running_before(binned.groupBy("bin").agg(F.count("*").alias("n")), "bin", "n", "before")
    share = distances.agg(F.expr(f"count(*) div {one_in}").alias("wanted"))
    rank = F.row_number().over(Window.partitionBy("bin").orderBy(F.desc(distance), key)) + F.col("before")
    ranked = binned.join(bins.select("bin", "before"), "bin").withColumn("rank", rank).join(F.broadcast(share))
    return ranked.where("rank <= wanted").select(*distances.columns)
