"""Augmentations and tiles of voxel tables, with fixed parameters, so a repeated run gives the same volume."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators.grid import running_before, shape
from stratovox.operators.volumes import flipped
from stratovox.sources.volumes import AXES, dense


def intensity(value: Column, contrast: float = 1.0, brightness: float = 0.0, gamma: float = 1.0, invert: bool = False) -> Column:
    """Contrast around one half, brightness, the cut to [0, 1], inversion and gamma, in this order."""
    stretched = F.least(F.greatest((value - 0.5) * contrast + (0.5 + brightness), F.lit(0.0)), F.lit(1.0))
    return F.pow(F.lit(1.0) - stretched if invert else stretched, F.lit(gamma))


def without_slices(volume: DataFrame, lost: Column) -> DataFrame:
    """The volume without the slices for which ``lost`` (of z) holds; the others close up. Slices are ranked in levels and joined, however many there are."""
    kept = running_before(volume.select("z").distinct().where(~lost).withColumn("one_", F.lit(1)), "z", "one_", "place_")
    rest = [c for c in volume.columns if c != "z"]
    return volume.join(kept.select("z", "place_"), "z").select(F.col("place_").cast("int").alias("z"), *rest)


def filled_with_mean(volume: DataFrame, value: str, where: Column) -> DataFrame:
    """Where a condition holds the value is its slice's mean; voxels without a row are 0."""
    volume = dense(volume.select(*AXES, *(c for c in volume.columns if c not in AXES)))
    means = volume.groupBy("z").agg(F.avg(value).alias("mean_"))
    return volume.join(means, "z").select(*AXES, F.when(where, F.col("mean_")).otherwise(F.col(value)).alias(value))


def displaced_below(volume: DataFrame, value: str, first: int, by: tuple[int, int], fill=0) -> DataFrame:
    """Slices from ``first`` on are moved by rows and columns; what moves in is ``fill``, what moves out is lost."""
    below = F.col("z") >= first
    moved = volume.select("z", *(F.when(below, F.col(a) + d).otherwise(F.col(a)).cast("int").alias(a) for a, d in zip("yx", by)), F.col(value).alias("moved_"))
    kind = dict(volume.dtypes)[value]
    return volume.select(*AXES).join(moved, list(AXES), "left").select(*AXES, F.coalesce("moved_", F.lit(fill)).cast(kind).alias(value))


def blurred_slices(volume: DataFrame, value: str, which: Column, reach: int = 1) -> DataFrame:
    """Chosen slices lose their focus: the value is the mean over ``reach`` voxels to each side along x, then along y; voxels without a row are 0."""
    from pyspark.sql import Window

    out = dense(volume.select(*AXES, value)).select(*AXES, F.col(value).alias("own_"), F.col(value).alias(value))
    for a in ("x", "y"):
        line = Window.partitionBy(*(b for b in AXES if b != a)).orderBy(a).rangeBetween(-reach, reach)
        out = out.withColumn(value, F.avg(value).over(line))
    return out.select(*AXES, F.when(which, F.col(value)).otherwise(F.col("own_")).alias(value))


def cut_out(volume: DataFrame, value: str, boxes: list[tuple[tuple[int, ...], tuple[int, ...]]], fill=0) -> DataFrame:
    """Boxes [low, high) set to ``fill``."""
    inside = reduce(lambda a, b: a | b, (reduce(lambda a, b: a & b, ((F.col(a) >= k) & (F.col(a) < h) for a, k, h in zip(AXES, low, high))) for low, high in boxes))
    kind = dict(volume.dtypes)[value]
    return volume.select(*AXES, F.when(inside, F.lit(fill)).otherwise(F.col(value)).cast(kind).alias(value))


def combined(volume: DataFrame, *steps) -> DataFrame:
    """Augmentations one after another; each takes and returns a volume."""
    return reduce(lambda v, step: step(v), steps, volume)


def merged_flips(volume: DataFrame, value: str, flips: list[tuple[str, ...]]) -> DataFrame:
    """``z, y, x, mean, low, high`` of predictions that were made of mirrored volumes: each is mirrored back and all are merged by voxel."""
    rows = volume.select(*AXES, value)
    back = reduce(DataFrame.unionByName, (flipped(rows, f) if f else rows for f in flips))
    return back.groupBy(*AXES).agg(F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))


def read_tiles(volume: DataFrame, value: str, stored: DataFrame, tile: tuple[int, int], low: tuple[int, ...], high: tuple[int, ...], missing=128) -> DataFrame:
    """A box read from stored tiles (``z, r, c``): only tiles that the box touches are asked for, and what a missing one would hold is ``missing``."""
    box = volume
    for a, k, h in zip(AXES, low, high):
        box = box.where((F.col(a) >= k) & (F.col(a) < h))
        if a != "z":
            t = tile[0] if a == "y" else tile[1]
            stored = stored.where(F.col("r" if a == "y" else "c").between(k // t, (h - 1) // t))
    place = [F.expr(f"cast(y div {tile[0]} as int)").alias("r"), F.expr(f"cast(x div {tile[1]} as int)").alias("c")]
    found = box.select(*AXES, *place, value).join(stored.select("z", "r", "c").withColumn("there_", F.lit(True)), ["z", "r", "c"], "left")
    return found.select(*AXES, F.when(F.col("there_"), F.col(value)).otherwise(F.lit(missing)).cast("int").alias(value))


def tile_names(depth: int, pattern: str) -> list[str]:
    """Names of a stack's slices: ``{z}`` of the pattern is the number, with leading zeros for the deepest one."""
    digits = len(str(max(1, depth)))
    return [pattern.replace("{z}", str(z).zfill(digits)) for z in range(depth)]


def chunk_of_number(number: Column, chunks: tuple[int, int, int], step: int = 1) -> list[Column]:
    """Bounds of a tile data set's chunk by its number (z slowest), from the volume's size; with a step of 2 neighbours overlap by half."""
    nz, ny, nx = chunks
    places = (F.floor(number / (ny * nx)), F.floor(number / nx) % ny, number % nx)
    out = []
    for a, p, n in zip(AXES, places, chunks):
        for end, shift in ((1, 0), (2, step)):
            out.append(F.floor((p + shift) / F.lit(n + step - 1) * F.col(f"n{a}")).cast("int").alias(f"{a}{end}"))
    return out


def chunk_bounds(volume: DataFrame, chunks: tuple[int, int, int], step: int = 1) -> DataFrame:
    """``chunk`` and its bounds of every chunk."""
    rows = shape(volume).select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks[0] * chunks[1] * chunks[2] - 1))).alias("chunk"))
    return rows.select("chunk", *chunk_of_number(F.col("chunk"), chunks, step))
