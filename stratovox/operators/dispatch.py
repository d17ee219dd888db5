"""Learning targets of a label volume by options written as text, all in one long table.

Tables of voxels and of parts are joined by shuffles, by a hint: they compress well, so their files look small enough for a broadcast, which the memory of no driver holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.operators import decoders, objects, stencils, targets
from stratovox.operators.distances import distance_transform
from stratovox.operators.grid import shape
from stratovox.operators.labels import grid_components
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES, dense

#: Spacing of semantic distances in three dimensions: slices lie farther apart.
SLICES_APART = (6.0, 1.0, 1.0)


def _channels(rows: DataFrame, *columns) -> DataFrame:
    parts = F.array(*(F.struct(F.lit(k).alias("channel"), c.cast("double").alias("value")) for k, c in enumerate(columns)))
    return rows.select(*AXES, F.explode(parts).alias("p")).select("p.channel", *AXES, "p.value")


def object_distance(rows: DataFrame, label: str, mode: str = "2d", padding: bool = False, quantise: bool = False, slices_apart: float = 1.0) -> DataFrame:
    """``z, y, x, energy``: the distance to the border of the own part as a share of the part's greatest distance; -1 outside.

    Parts are face-connected pieces of a label, in the slice (``2d``, where all distances are 1 a voxel) or in the volume. ``padding``: what lies around the
    volume counts as background. ``quantise``: levels from 0 to 10 instead. A part without a border has no distance: -1.
    """
    flat = mode == "2d"
    key = F.struct(F.col("z").alias("slice"), F.col(label).alias("l")) if flat else F.struct(F.lit(0).alias("slice"), F.col(label).alias("l"))
    if flat:
        parts = decoders.in_slices(rows.where(F.col(label) != 0).select(*AXES, key.alias("key_")), "z")
        parts = rows.select(*AXES).join(parts.hint("merge"), list(AXES), "left").select(*AXES, F.coalesce("component", F.lit(0)).alias("part_"))
    else:
        parts = grid_components(rows, label).withColumnRenamed("component", "part_")
    parts, low, high = saved(parts, "parts"), None, None
    if padding:
        size = shape(parts).first()
        ends = [size[f"n{a}"] or 0 for a in AXES]
        low, high = (0 if flat else -1, -1, -1), (ends[0] + (not flat), ends[1] + 1, ends[2] + 1)
    spacing = (slices_apart, 1.0, 1.0)
    found = distance_transform(parts, "part_", spacing, low, high, ("y", "x") if flat else AXES)
    inside = saved(found.join(parts.where("part_ <> 0").hint("merge"), list(AXES)).where("distance > 0"), "inside")
    most = inside.groupBy("part_").agg((F.max("distance") + 1e-6).alias("most_"))
    energy = inside.join(most.hint("merge"), "part_").select(*AXES, (F.col("distance") / F.col("most_")).alias("energy"))
    out = rows.select(*AXES).join(energy.hint("merge"), list(AXES), "left").select(*AXES, F.coalesce("energy", F.lit(-1.0)).alias("energy"))
    return out.select(*AXES, stencils.quantised(F.col("energy")).alias("energy")) if quantise else out


def semantic_distance(rows: DataFrame, label: str, mode: str = "2d", fore: float = 8.0, back: float = 50.0) -> DataFrame:
    """``z, y, x, energy``: the tanh of the distance to background in ``fore`` voxels less the distance to foreground in ``back`` voxels; a slice (a volume) of one
    kind counts with 5."""
    flat = mode == "2d"
    mask = rows.select(*AXES, (F.col(label) != 0).cast("int").alias("in_"), (F.col(label) == 0).cast("int").alias("out_"))
    mask = saved(mask, "mask")
    axes, spacing = (("y", "x"), (1.0, 1.0, 1.0)) if flat else (AXES, SLICES_APART)
    both = None
    for side, scale in (("in_", fore), ("out_", back)):
        d = distance_transform(mask, side, spacing, axes=axes)
        d = d.select(*AXES, F.when(F.col("distance") < 0, F.lit(5.0)).otherwise(F.col("distance") / F.lit(float(scale))).alias(side))
        both = d if both is None else both.join(d.hint("merge"), list(AXES))
    return both.select(*AXES, F.tanh(F.col("in_") - F.col("out_")).alias("energy"))


def one_target(volume: DataFrame, label: str, option: str) -> DataFrame:
    """``channel, z, y, x, value`` of one option, for every voxel of the bounding box.

    ``0`` foreground (``0-a-b``: the listed ids); ``1`` sending, receiving and any side of synapses (``1-1``: classes 0, 1, 2); ``2`` affinities
    (``2-z-y-x-version``); ``3-size-ratio-dilation`` parts of slices of fewer voxels than ``size`` (across y and x fewer than ``size`` by ``ratio``; the last number isn't
    used); ``4-width-background`` contours, between objects alone if the last is 0; ``5-mode-padding-quantise-spacing-erosion`` distance in the object (erosion 0 only);
    ``6-mode-fore-back`` semantic distance; ``7`` flows along y and x (``7-0``: and foreground); ``8-reach-...`` as 5 for labels grown over windows of ``reach`` voxels;
    ``9`` the label.
    """
    rows = dense(volume.select(*AXES, F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("l")))
    kind, *rest = option.split("-")
    value = F.col("l")
    if kind == "0":
        return _channels(rows, targets.binary(value, option).cast("int"))
    if kind == "1":
        odd, even = (value > 0) & (value % 2 == 1), (value > 0) & (value % 2 == 0)
        return _channels(rows, F.when(odd, 1).when(even, 2).otherwise(0)) if rest else _channels(rows, odd.cast("int"), even.cast("int"), (value > 0).cast("int"))
    if kind == "2":
        found = targets.affinities(rows, "l", option)
        return _channels(found, *(F.col(f"aff_{a}") for a in AXES))
    if kind == "3":
        size, ratio = int(rest[0]), int(rest[1])
        return _channels(decoders.small_in_slices(rows, "l", (size, size // ratio, size // ratio)), F.col("small"))
    if kind == "4":
        width, background = int(rest[0]), int(rest[1])
        if background:
            return _channels(stencils.boundaries(rows, "l", width, True), F.col("boundary"))
        seen = rows.withColumn("seen", F.when(value != 0, value))
        low = stencils.box(seen, "seen", (0, width, width), "min", "low", True)
        both = stencils.box(low, "seen", (0, width, width), "max", "high", True)
        return _channels(both, F.coalesce(F.col("low") < F.col("high"), F.lit(False)).cast("int"))
    if kind in ("5", "8"):
        if kind == "8":
            reach = int(rest.pop(0))
            before, after = reach // 2, (reach - 1) // 2  # a window of an even size lies towards the lower end
            for a in AXES:
                rows = rows.withColumn("l", F.max("l").over(stencils.line(a).rowsBetween(-before, after)))
            rest = rest[1:] if rest and rest[0] == "5" else rest
        mode, padding, levels, apart, erosion = (*rest, *("2d", "0", "0", "5.0", "0")[len(rest) :])
        if int(erosion):
            raise ValueError("distances of eroded objects aren't built")
        return _channels(object_distance(rows, "l", mode, bool(int(padding)), bool(int(levels)), float(apart)), F.col("energy"))
    if kind == "6":
        mode, fore, back = rest or ("2d", "8", "50")
        return _channels(semantic_distance(rows, "l", mode, float(fore), float(back)), F.col("energy"))
    if kind == "7":
        found = rows.join(objects.flows(rows, "l").hint("merge"), list(AXES), "left").select(*AXES, "l", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("dy", "dx")))
        return _channels(found, F.col("dy"), F.col("dx"), *([(value > 0).cast("int")] if "0" in rest else []))
    if kind == "9":
        return _channels(rows, value)
    raise ValueError(f"unknown target option {option}")


def to_targets(volume: DataFrame, label: str, options: list[str]) -> DataFrame:
    """``target`` (the option's number), ``channel, z, y, x, value`` of several options; the volume is filled and written once."""
    rows = saved(dense(volume.select(*AXES, F.coalesce(F.col(label).cast("long"), F.lit(0)).alias("l"))), "labels")
    parts = [one_target(rows, "l", o).select(F.lit(k).alias("target"), "channel", *AXES, "value") for k, o in enumerate(options)]
    return reduce(DataFrame.unionByName, parts)
