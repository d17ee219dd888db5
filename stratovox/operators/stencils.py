"""Neighbourhood operations on voxel tables.

A stencil along one axis is a window partitioned by the other two, so its work is spread over all lines of the
volume; box stencils are taken axis by axis. A missing row is background, so volumes with holes are filled
first (:func:`stratovox.sources.volumes.dense`), and results have a row for every voxel of the volume's bounding box. Finding out
whether there are holes reads the coordinates once; ``filled`` says that there are none, and no job runs while the plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratovox.sources.volumes import AXES, dense


def line(axis: str):
    """The window of all voxels of a line along ``axis``, in order."""
    return Window.partitionBy(*(a for a in AXES if a != axis)).orderBy(axis)


def before(value: str | Column, axis: str, distance: int = 1, *within: str) -> Column:
    """The value of the voxel ``distance`` before along ``axis`` (null if there is none), whatever rows are missing; ``within``: columns that
    both voxels share, such as a block."""
    place = Window.partitionBy(*within, *(a for a in AXES if a != axis)).orderBy(axis).rangeBetween(-distance, -distance)
    return F.max(value).over(place)


def affinities(volume: DataFrame, label: str, distances: tuple[int, int, int] = (1, 1, 1), filled: bool = False) -> DataFrame:
    """``aff_z, aff_y, aff_x``: 1 where a voxel and the one ``distance`` before it have one id, not 0; the border compares with itself."""
    volume = volume if filled else dense(volume)
    value = F.col(label)
    out = [
        F.when((F.coalesce(F.lag(label, d).over(line(a)), value) == value) & (value > 0), 1).otherwise(0).alias(f"aff_{a}") for a, d in zip(AXES, distances)
    ]
    return volume.select(*AXES, *out)


def clamped_affinities(volume: DataFrame, label: str, distances: tuple[int, int, int], filled: bool = False) -> DataFrame:
    """As :func:`affinities`, but the border compares with the first voxel of the line."""
    volume = volume if filled else dense(volume)
    value = F.col(label)
    before = lambda a, d: F.coalesce(F.lag(label, d).over(line(a)), F.first(label).over(line(a).rowsBetween(Window.unboundedPreceding, 0)))
    return volume.select(*AXES, *(F.when((before(a, d) == value) & (value > 0), 1).otherwise(0).alias(f"aff_{a}") for a, d in zip(AXES, distances)))


def central_affinities(volume: DataFrame, label: str, distances: tuple[int, int, int], filled: bool = False) -> DataFrame:
    """1 where the voxels ``distance`` before and after have one id, not 0; 0 where either is missing."""
    volume = volume if filled else dense(volume)
    both = lambda a, d: F.coalesce((F.lag(label, d).over(line(a)) == F.lead(label, d).over(line(a))) & (F.lag(label, d).over(line(a)) > 0), F.lit(False))
    return volume.select(*AXES, *(both(a, d).cast("int").alias(f"aff_{a}") for a, d in zip(AXES, distances)))


def offset_affinities(volume: DataFrame, label: str, offsets: list[tuple[int, int, int]], filled: bool = False) -> DataFrame:
    """``edge, z, y, x, aff``: whether a voxel and the one at each offset have one id, not 0; pairs that leave the volume are left out."""
    volume = volume if filled else dense(volume)
    far = volume.select(F.posexplode(F.array(*(F.struct(*(F.lit(v).alias(f"o{a}") for a, v in zip(AXES, o))) for o in offsets))).alias("edge", "o"), *AXES, F.col(label).alias("far"))
    far = far.select("edge", *((F.col(a) - F.col(f"o.o{a}")).alias(a) for a in AXES), "far")
    joined = volume.select(*AXES, F.col(label).alias("near")).join(far.hint("merge"), list(AXES))
    return joined.select("edge", *AXES, ((F.col("near") == F.col("far")) & (F.col("near") > 0)).cast("int").alias("aff"))


def box(volume: DataFrame, column: str, reach: tuple[int, int, int], how: str, name: str, filled: bool = False) -> DataFrame:
    """Add the min, max or sum of ``column`` over the box of ``reach`` voxels to each side, axis by axis."""
    volume = volume if filled else dense(volume)
    step = {"min": F.min, "max": F.max, "sum": F.sum}[how]
    out = volume.withColumn(name, F.col(column))
    for axis, r in zip(AXES[::-1], reach[::-1]):
        if r:
            out = out.withColumn(name, step(name).over(line(axis).rowsBetween(-r, r)))
    return out


def eroded(volume: DataFrame, mask: str, reach: tuple[int, int, int], name: str, filled: bool = False) -> DataFrame:
    """1 where the whole box is set; outside the volume counts as unset."""
    size = reduce(lambda a, b: a * b, (2 * r + 1 for r in reach))
    return box(volume, mask, reach, "sum", name, filled).withColumn(name, (F.col(name) == size).cast("int"))


def boundaries(volume: DataFrame, label: str, width: int = 1, filled: bool = False) -> DataFrame:
    """``boundary``: 1 near a change of label within the slice, grown by ``width``."""
    volume = volume if filled else dense(volume)
    value = F.col(label)
    changed = [F.coalesce(F.lag(label).over(line(a)), value) != F.coalesce(F.lead(label).over(line(a)), value) for a in ("y", "x")]
    edge = volume.select(*AXES, (changed[0] | changed[1]).cast("int").alias("edge"))
    return box(edge, "edge", (0, width, width), "max", "boundary", True).select(*AXES, "boundary")


def widened_border(volume: DataFrame, label: str, width: int = 1, filled: bool = False) -> DataFrame:
    """The label, 0 where the slice's window holds two different labels that aren't 0."""
    volume = volume if filled else dense(volume)
    rows = volume.select(*AXES, F.col(label).alias("v"), F.when(F.col(label) != 0, F.col(label)).alias("seen"))
    low = box(rows, "seen", (0, width, width), "min", "low", True)
    both = box(low, "seen", (0, width, width), "max", "high", True)
    return both.select(*AXES, F.when(F.col("low") < F.col("high"), F.lit(0)).otherwise(F.col("v")).cast("long").alias(label))


def majority(volume: DataFrame, score: Column, reach: tuple[int, int, int], filled: bool = False) -> DataFrame:
    """``kept``: whether most of the full box (outside counts as unset) is set: the binary median."""
    size = reduce(lambda a, b: a * b, (2 * r + 1 for r in reach))
    return box(volume.select(*AXES, score.cast("int").alias("s")), "s", reach, "sum", "n", filled).select(*AXES, (F.col("n") * 2 > size).alias("kept"))


def valid_windows(volume: DataFrame, mask: Column, window: tuple[int, int, int], ratio: float, filled: bool = False) -> DataFrame:
    """Starts of windows that lie in the volume and of which at least ``ratio`` is set."""
    rows = volume.select(*AXES, mask.cast("int").alias("n"))
    rows = (rows if filled else dense(rows)).withColumn("size", F.lit(1))
    for axis, w in zip(AXES[::-1], window[::-1]):
        frame = line(axis).rowsBetween(0, w - 1)
        rows = rows.withColumn("n", F.sum("n").over(frame)).withColumn("size", F.sum("size").over(frame))
    full = reduce(lambda a, b: a * b, window)
    return rows.where((F.col("size") == full) & (F.col("n") >= ratio * full)).select(*AXES, "n")


def quantised(value: Column, levels: int = 10) -> Column:
    """Bin of an energy in [-1, 1]: 0 below 0, then ``levels`` equal bins of [0, 1]."""
    return F.when(value < 0, F.lit(0)).otherwise(F.least(F.floor(value * levels).cast("int") + 1, F.lit(levels))).cast("int")


def blended(patches: DataFrame, keys: tuple[str, ...] = AXES) -> DataFrame:
    """Weighted overlap-add of predictions: ``value`` (negatives count as 0) by ``weight``, as whole numbers to 255."""
    value = F.greatest(F.col("value"), F.lit(0.0))
    return patches.groupBy(*keys).agg((F.sum(value * F.col("weight")) / F.sum("weight")).alias("p")).select(*keys, F.floor(F.col("p") * 255 + 1e-9).cast("int").alias("value"))
