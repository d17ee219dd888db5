"""Crops, masks, padding, flips and resolution changes of voxel tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators.grid import shape
from stratovox.sources.volumes import AXES


def masked(volume: DataFrame, mask: DataFrame, value: str, mask_value: str) -> DataFrame:
    """Product with a mask of the same voxels; voxels that the mask lacks are dropped (background)."""
    return volume.join(mask.select(*AXES, F.col(mask_value).alias("m_")).hint("merge"), list(AXES)).select(*AXES, (F.col(value) * F.col("m_")).alias(value))


def trimmed(volume: DataFrame, value: str) -> DataFrame:
    """The bounding box of what isn't 0, moved to the origin."""
    bounds = volume.where(F.col(value) != 0).agg(*(f(a).alias(f"{a}{n}") for a in AXES for f, n in ((F.min, 1), (F.max, 2))))
    rows = volume.join(F.broadcast(bounds))
    for a in AXES:
        rows = rows.where(F.col(a).between(F.col(f"{a}1"), F.col(f"{a}2")))
    return rows.select(*((F.col(a) - F.col(f"{a}1")).alias(a) for a in AXES), value)


def _coarse(volume: DataFrame, factor: tuple[int, int, int]) -> list[Column]:
    return [F.expr(f"cast({a} div {f} as int)").alias(a) for a, f in zip(AXES, factor)]


def downsampled_mean(volume: DataFrame, value: str, factor: tuple[int, int, int], size: tuple[int, int, int] | None = None) -> DataFrame:
    """The mean of each cell's voxels, those without a row counted as 0; cells at the volume's end hold what is left of it. ``size``: the volume's, by
    default from its greatest coordinates."""
    sums = volume.groupBy(*_coarse(volume, factor)).agg(F.sum(value).alias(value))
    ends = F.broadcast(shape(volume)) if size is None else None
    rows = sums.join(ends) if ends is not None else sums.select("*", *(F.lit(n).alias(f"n{a}") for a, n in zip(AXES, size)))
    voxels = reduce(lambda p, q: p * q, (F.least(F.lit(f), F.col(f"n{a}") - F.col(a) * f) for a, f in zip(AXES, factor)))
    return rows.select(*AXES, (F.col(value) / voxels).alias(value))


def downsampled_mode(volume: DataFrame, label: str, factor: tuple[int, int, int]) -> DataFrame:
    """The most frequent label of each cell, the least one on ties: two aggregations, no sort of a cell's voxels."""
    counts = volume.groupBy(*_coarse(volume, factor), label).agg(F.count("*").alias("n"))
    best = counts.groupBy(*AXES).agg(F.max(F.struct("n", (-F.col(label)).alias("l"))).alias("b"))
    return best.select(*AXES, (-F.col("b.l")).alias(label))


def pyramid(volume: DataFrame, label: str, factor: tuple[int, int, int], levels: int) -> DataFrame:
    """``mip`` and the volume of each resolution, each made from the one before."""
    level, out = volume.select(*AXES, label), None
    for mip in range(1, levels + 1):
        level = downsampled_mode(level, label, factor)
        part = level.select(F.lit(mip).alias("mip"), *AXES, label)
        out = part if out is None else out.unionByName(part)
    return out


def resized_nearest(volume: DataFrame, value: str, factor: tuple[float, float, float]) -> DataFrame:
    """Nearest voxel of a grid scaled by ``factor``: each voxel is copied to the places whose source it is, without a join."""
    out = volume.join(F.broadcast(shape(volume)))
    for a, f in zip(AXES, factor):
        n = F.greatest(F.lit(1), F.round(F.col(f"n{a}") * f)).cast("int")
        low, high = F.ceil(F.col(a) * n / F.col(f"n{a}")).cast("int"), F.ceil((F.col(a) + 1) * n / F.col(f"n{a}")).cast("int") - 1
        out = out.where(low <= high).withColumn(f"t{a}", F.explode(F.sequence(low, high)))
    return out.select(*(F.col(f"t{a}").alias(a) for a in AXES), value)


def flipped(volume: DataFrame, axes: tuple[str, ...], transpose: bool = False) -> DataFrame:
    """Mirror some axes, then swap y and x if ``transpose``."""
    rest = [c for c in volume.columns if c not in AXES]
    rows = volume.join(F.broadcast(shape(volume)))
    place = {a: (F.col(f"n{a}") - 1 - F.col(a) if a in axes else F.col(a)) for a in AXES}
    y, x = ("x", "y") if transpose else ("y", "x")
    return rows.select(place["z"].alias("z"), place[y].alias("y"), place[x].alias("x"), *rest)


def reflect_padded(volume: DataFrame, pad: tuple[int, int, int]) -> DataFrame:
    """A volume with mirrored borders (the border voxel isn't repeated): voxels near a side are copied beyond it."""
    rest = [c for c in volume.columns if c not in AXES]
    out = volume.join(F.broadcast(shape(volume)))
    for a, p in zip(AXES, pad):
        v, n = F.col(a), F.col(f"n{a}")
        places = F.array(v, F.when((v >= 1) & (v <= p), -v), F.when((v <= n - 2) & (v >= n - 1 - p), 2 * (n - 1) - v))
        out = out.withColumn(a, F.explode(F.filter(places, lambda q: q.isNotNull())))
    return out.select(*((F.col(a) + p).alias(a) for a, p in zip(AXES, pad)), *rest)


def normalised_range(volume: DataFrame, value: str) -> DataFrame:
    """Values stretched to 0..255 as whole numbers; a constant volume becomes 0."""
    bounds = volume.agg(F.min(value).alias("low_"), F.max(value).alias("high_"))
    stretched = F.when(F.col("high_") > F.col("low_"), (F.col(value) - F.col("low_")) / (F.col("high_") - F.col("low_")) * 255).otherwise(F.lit(0.0))
    return volume.join(F.broadcast(bounds)).select(*AXES, F.floor(stretched + 1e-9).cast("int").alias(value))
