"""Crops, patches, windows and padding of voxel tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators.grid import shape
from stratovox.sources.volumes import AXES, region


def crop(volume: DataFrame, low: tuple[int, ...], high: tuple[int, ...], inclusive: bool = False) -> DataFrame:
    """The box [low, high) (or with its upper ends, if ``inclusive``) moved to the origin; bounds are predicates of the scan."""
    rest = [c for c in volume.columns if c not in AXES]
    found = region(volume, low, tuple(h + inclusive for h in high))
    return found.select(*((F.col(a) - k).alias(a) for a, k in zip(AXES, low)), *rest)


def cells(spark, size: tuple[int, ...]) -> DataFrame:
    """``z, y, x`` of every voxel of a box at the origin."""
    nz, ny, nx = size
    place = (F.expr(f"id div {ny * nx}"), F.expr(f"id div {nx} % {ny}"), F.expr(f"id % {nx}"))
    return spark.range(nz * ny * nx).select(*(p.cast("int").alias(a) for p, a in zip(place, AXES)))


def padded_crop(volume: DataFrame, value: str, low: tuple[int, ...], high: tuple[int, ...], fill, mask: Column | None = None) -> DataFrame:
    """A full box of the size of [low, high), which may reach outside: ``fill`` outside of the volume and where it has no row, 0 outside of the mask."""
    inside = volume.withColumn(value, F.when(mask, F.col(value)).otherwise(F.lit(0))) if mask is not None else volume
    found = crop(inside.select(*AXES, value), low, high).withColumn("row_", F.lit(True))
    box = cells(volume.sparkSession, tuple(h - k for k, h in zip(low, high))).join(found, list(AXES), "left")
    kind = dict(volume.dtypes)[value]
    return box.select(*AXES, F.when(F.col("row_"), F.col(value)).otherwise(F.lit(fill)).cast(kind).alias(value))


def pasted(volume: DataFrame, patch: DataFrame, value: str, at: tuple[int, ...], background: bool = False) -> DataFrame:
    """The volume with a patch (at the origin) put at ``at``; zeros of the patch cover only with ``background``."""
    moved = patch.select(*((F.col(a) + k).alias(a) for a, k in zip(AXES, at)), F.col(value).alias("patch_"))
    if not background:
        moved = moved.where(F.col("patch_") != 0)
    return volume.join(moved, list(AXES), "left").select(*AXES, F.coalesce("patch_", value).alias(value))


def window_of_size(low: Column, high: Column, size: int) -> tuple[Column, Column]:
    """The window of ``size`` around the middle of [low, high): grown or shrunk by half of the difference, rounded down, at the lower end."""
    half = F.floor(F.abs(F.lit(size) - (high - low)) / 2).cast("int")
    start = F.when(high - low >= size, low + half).otherwise(low - half)
    return start, start + size


def centre_crop(volume: DataFrame, size: tuple[int, ...]) -> DataFrame:
    """The middle box of ``size``, moved to the origin; the lower margin is the smaller one."""
    rest = [c for c in volume.columns if c not in AXES]
    rows = volume.join(F.broadcast(shape(volume)))
    start = {a: F.floor((F.col(f"n{a}") - s) / 2).cast("int") for a, s in zip(AXES, size)}
    for a, s in zip(AXES, size):
        rows = rows.where((F.col(a) >= start[a]) & (F.col(a) < start[a] + s))
    return rows.select(*((F.col(a) - start[a]).alias(a) for a in AXES), *rest)


def pad_sizes(pads: int | list[int], axes: int = 3) -> list[tuple[int, int]]:
    """(before, after) of each axis from one number, one for each axis, or two for each axis."""
    given = [pads] if isinstance(pads, int) else list(pads)
    if len(given) == 1:
        return [(given[0], given[0])] * axes
    if len(given) == axes:
        return [(p, p) for p in given]
    if len(given) != 2 * axes:
        raise ValueError(f"{len(given)} pads for {axes} axes")
    return list(zip(given[::2], given[1::2]))


def unpadded(volume: DataFrame, pads: int | list[int]) -> DataFrame:
    """The volume without its borders, moved to the origin."""
    rest = [c for c in volume.columns if c not in AXES]
    rows = volume.join(F.broadcast(shape(volume)))
    sizes = dict(zip(AXES, pad_sizes(pads)))
    for a, (before, after) in sizes.items():
        rows = rows.where((F.col(a) >= before) & (F.col(a) < F.col(f"n{a}") - after))
    return rows.select(*((F.col(a) - sizes[a][0]).alias(a) for a in AXES), *rest)


def padded(volume: DataFrame, pads: int | list[int], mode: str = "symmetric") -> DataFrame:
    """The volume with borders: ``symmetric`` mirrors with the border voxel, ``edge`` repeats it. Voxels near a side are copied beyond it."""
    rest = [c for c in volume.columns if c not in AXES]
    out = volume.join(F.broadcast(shape(volume)))
    for a, (before, after) in zip(AXES, pad_sizes(pads)):
        v, n = F.col(a), F.col(f"n{a}")
        if mode == "symmetric":
            places = F.array(v, F.when(v < before, -1 - v), F.when(v >= n - after, 2 * n - 1 - v))
        elif mode == "edge":
            beyond = lambda hit, ends: F.when(hit, ends).otherwise(F.array().cast("array<int>"))
            lower = F.sequence(F.lit(-before), F.lit(-1)) if before else F.array().cast("array<int>")
            upper = F.sequence(n.cast("int"), (n + after - 1).cast("int")) if after else F.array().cast("array<int>")
            places = F.concat(F.array(v.cast("int")), beyond(v == 0, lower), beyond(v == n - 1, upper))
        else:
            raise ValueError(f"unknown mode {mode}")
        out = out.withColumn(a, F.explode(F.filter(places, lambda q: q.isNotNull())))
    return out.select(*((F.col(a) + p[0]).cast("int").alias(a) for a, p in zip(AXES, pad_sizes(pads))), *rest)


def sliding_patches(image: DataFrame, value: str, size: tuple[int, int], step: int = 1) -> DataFrame:
    """``y0, x0, place, value`` of every window of a slice: a voxel is copied to the windows that hold it, without a join."""
    rows = image.join(F.broadcast(image.agg(F.max("y").alias("my"), F.max("x").alias("mx"))))
    for a, s in zip("yx", size):
        first = F.greatest(F.lit(0), F.ceil((F.col(a) - s + 1) / step)).cast("int")
        last = F.least(F.floor(F.col(a) / step), F.floor((F.col(f"m{a}") + 1 - s) / step)).cast("int")
        rows = rows.where(first <= last).withColumn(f"{a}0", F.explode(F.transform(F.sequence(first, last), lambda k: k * step)))
    place = (F.col("y") - F.col("y0")) * size[1] + F.col("x") - F.col("x0")
    return rows.select(*[c for c in image.columns if c not in ("y", "x", value)], "y0", "x0", place.cast("int").alias("place"), value)
