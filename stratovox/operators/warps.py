"""Interpolating changes of a volume's grid: linear resizing, affine maps (rotation, rescaling) and displacement fields.

Along an axis, linear resizing scatters: each voxel adds its share to the one or few target places around it, so a pass is one
pre-aggregated sum and needs no join. Maps that mix axes gather: each target voxel asks the voxels around its source place by
an equi-join on their coordinates. Missing rows are background (0).
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators.grid import shape
from stratovox.sources.volumes import AXES

Size = tuple[int, int, int]


def extent(volume: DataFrame) -> Size:
    """The volume's size, from its greatest coordinates."""
    found = shape(volume).first()
    return tuple(found[f"n{a}"] or 0 for a in AXES)


def resized_linear(volume: DataFrame, value: str, target: Size | None = None, factor: tuple[float, float, float] | None = None, size: Size | None = None) -> DataFrame:
    """The volume on a grid of ``target`` voxels (or its size times ``factor``, rounded), linear along each axis; first and last voxels of an axis lie on
    each other. Every target voxel has a row; an axis of one target voxel takes the first source voxel."""
    size = size or extent(volume)
    if 0 in size:
        return volume.select(*AXES, F.col(value).cast("double").alias(value)).limit(0)
    target = target or tuple(max(1, math.floor(n * f + 0.5)) for n, f in zip(size, factor))
    out = volume.select(*AXES, F.col(value).cast("double").alias(value))
    for k, a in enumerate(AXES):
        n, m = size[k], target[k]
        if n == m:
            continue
        if m == 1:
            out = out.where(F.col(a) == 0)
            continue
        step = (n - 1) / (m - 1)  # source voxels from one target voxel to the next
        if step == 0:
            places = F.sequence(F.lit(0), F.lit(m - 1))
            out = out.withColumn(a, F.explode(places))
            continue
        low, high = F.greatest(F.lit(0), F.floor((F.col(a) - 1) / step).cast("int")), F.least(F.lit(m - 1), F.ceil((F.col(a) + 1) / step).cast("int"))
        spread = out.withColumn("t_", F.explode(F.sequence(low, high)))
        # a source place is that of the target voxel in whole steps, so that shares of neighbours add up to one
        source = (F.col("t_") * F.lit(n - 1)) / F.lit(float(m - 1))
        spread = spread.withColumn("w_", 1 - F.abs(source - F.col(a))).where("w_ > 0")
        keys = [F.col("t_").alias(b) if b == a else F.col(b) for b in AXES]
        out = spread.groupBy(*keys).agg(F.sum(F.col(value) * F.col("w_")).alias(value))
    cells = _grid(volume, target)
    return cells.join(out, list(AXES), "left").select(*AXES, F.coalesce(value, F.lit(0.0)).alias(value))


def _grid(volume: DataFrame, size: Size) -> DataFrame:
    """A row for every voxel of [0, size)."""
    place = [F.expr(f"cast(id div {size[1] * size[2]} as int)"), F.expr(f"cast(id div {size[2]} % {size[1]} as int)"), F.expr(f"cast(id % {size[2]} as int)")]
    return volume.sparkSession.range(size[0] * size[1] * size[2]).select(*(p.alias(a) for p, a in zip(place, AXES)))


def sampled(targets: DataFrame, volume: DataFrame, value: str, linear: bool = True, clamp: Size | None = None) -> DataFrame:
    """``z, y, x`` of ``targets`` and the volume's ``value`` at their source places ``sz, sy, sx``.

    ``linear``: from the (up to eight) voxels around, by their nearness; else that of the nearest voxel (halves go up). Places outside count as 0, or,
    with ``clamp`` (the volume's size), as the nearest voxel of the border. Targets without a place (null) are 0.
    """
    place = {a: F.col(f"s{a}") for a in AXES}
    if clamp:
        place = {a: F.least(F.greatest(place[a], F.lit(0.0)), F.lit(float(n - 1))) for a, n in zip(AXES, clamp)}
    kind = dict(volume.dtypes)[value]
    source = volume.select(*(F.col(a).cast("int").alias(f"s{a}") for a in AXES), F.col(value).alias("v_"))
    if not linear:
        asked = targets.select(*AXES, *(F.floor(place[a] + 0.5).cast("int").alias(f"s{a}") for a in AXES))
        return asked.join(source.hint("merge"), [f"s{a}" for a in AXES], "left").select(*AXES, F.coalesce("v_", F.lit(0)).cast(kind).alias(value))
    low = targets.select(*AXES, *(F.floor(place[a]).cast("int").alias(f"l{a}") for a in AXES), *((place[a] - F.floor(place[a])).alias(f"f{a}") for a in AXES))
    corners = []
    for up in product((0, 1), repeat=3):
        share = F.lit(1.0)
        for a, u in zip(AXES, up):
            share = share * (F.col(f"f{a}") if u else 1 - F.col(f"f{a}"))
        corners.append(F.struct(*((F.col(f"l{a}") + u).alias(f"s{a}") for a, u in zip(AXES, up)), share.alias("w")))
    near = low.select(*AXES, F.explode(F.filter(F.array(*corners), lambda c: F.coalesce(c["w"] > 0, F.lit(True)))).alias("c"))
    met = near.select(*AXES, *(F.col(f"c.s{a}").alias(f"s{a}") for a in AXES), F.col("c.w").alias("w_")).join(source.hint("merge"), [f"s{a}" for a in AXES], "left")
    return met.groupBy(*AXES).agg(F.coalesce(F.sum(F.col("v_").cast("double") * F.col("w_")), F.lit(0.0)).alias(value))


def affine(volume: DataFrame, value: str, matrix: list[list[float]], linear: bool = True, clamp: bool = False, size: Size | None = None) -> DataFrame:
    """The volume seen through ``matrix`` (3 by 3, from target to source, about the centre of the volume), on its own grid."""
    size = size or extent(volume)
    if 0 in size:
        return volume.select(*AXES, value).limit(0)
    middle = [(n - 1) / 2 for n in size]
    targets = _grid(volume, size)
    for a, row, c in zip(AXES, matrix, middle):
        terms = [(F.col(b) - F.lit(m)) * F.lit(float(f)) for b, m, f in zip(AXES, middle, row)]
        targets = targets.withColumn(f"s{a}", terms[0] + terms[1] + terms[2] + F.lit(c))
    return sampled(targets, volume, value, linear, size if clamp else None)


def rotated(volume: DataFrame, value: str, degrees: float, linear: bool = True, clamp: bool = False, size: Size | None = None) -> DataFrame:
    """Every slice turned about its centre."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return affine(volume, value, [[1, 0, 0], [0, c, -s], [0, s, c]], linear, clamp, size)


def rescaled(volume: DataFrame, value: str, factor: float, linear: bool = True, clamp: bool = False, size: Size | None = None) -> DataFrame:
    """Every slice enlarged (a factor above 1) or shrunk about its centre; the grid stays."""
    return affine(volume, value, [[1, 0, 0], [0, 1 / factor, 0], [0, 0, 1 / factor]], linear, clamp, size)


def displaced(volume: DataFrame, value: str, field: dict[str, Column], linear: bool = True, clamp: bool = False, size: Size | None = None) -> DataFrame:
    """The volume with each target voxel taken from its place plus a displacement; ``field``: an expression of z, y, x for each axis that moves."""
    size = size or extent(volume)
    if 0 in size:
        return volume.select(*AXES, value).limit(0)
    targets = _grid(volume, size).withColumns({f"s{a}": F.col(a) + field.get(a, F.lit(0.0)) for a in AXES})
    return sampled(targets, volume, value, linear, size if clamp else None)
