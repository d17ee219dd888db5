"""Training targets from label volumes, options written as text, and what decodes predictions back."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators import stencils
from stratovox.operators.stencils import before
from stratovox.sources.volumes import AXES, dense


def binary(label: Column, option: str = "0") -> Column:
    """Foreground of an option: ``0`` all labels, ``0-a-b`` the listed ones."""
    _, *listed = option.split("-")
    return label.isin(*map(int, listed)) if listed else label > 0


def directed_affinities(volume: DataFrame, label: str, distances: tuple[int, int, int] = (1, 1, 1)) -> DataFrame:
    """1 where a voxel and the one ``distance`` before it have one id, not 0; the border is 0. A negative distance stores
    the edge at the lower of its voxels."""
    rows, out = dense(volume), []
    for a, d in zip(AXES, distances):
        other = before(label, a, abs(d)) if d > 0 else before(label, a, -abs(d))
        out.append(F.when((F.coalesce(other, F.lit(0)) == F.col(label)) & (F.col(label) > 0), 1).otherwise(0).alias(f"aff_{a}"))
    return rows.select(*AXES, *out)


#: Affinity targets by the version that an option names.
AFFINITIES = {"v1": stencils.clamped_affinities, "v2": stencils.central_affinities, "pni": directed_affinities}


def affinities(volume: DataFrame, label: str, option: str = "2") -> DataFrame:
    """The affinities of an option: ``2`` plain ones, ``2-z-y-x-version`` distances and a version."""
    parts = option.split("-")
    if len(parts) == 1:
        return stencils.affinities(volume, label)
    _, z, y, x, version = parts
    return AFFINITIES[version](volume, label, (int(z), int(y), int(x)))


def half_ball(radius: float, axes: int = 3) -> list[tuple[int, ...]]:
    """Offsets within ``radius``, one of each opposite two, in rising order: the edges of a dense graph."""
    reach = range(-int(radius) - 1, int(radius) + 2)
    return [o for o in product(reach, repeat=axes) if sum(v * v for v in o) <= radius * radius and o < (0,) * axes]


def flat_and_below(radius: float, radius_below: float) -> list[tuple[int, int, int]]:
    """The half ball, and the disk of another radius in the slice below without its middle, for slices that lie far apart."""
    disk = [(-1, *o) for o in half_ball(radius_below, 2)]
    return [*half_ball(radius), *disk, *((-1, -y, -x) for _, y, x in disk)]


def ignored_far(volume: DataFrame, label: str, reach: tuple[int, int, int] = (0, 1, 1), times: int = 2) -> DataFrame:
    """Labels with -1 where no foreground lies within ``times`` steps of ``reach``."""
    rows = stencils.box(volume.select(*AXES, label).withColumn("fg_", (F.col(label) > 0).cast("int")), "fg_", tuple(r * times for r in reach), "max", "near_")
    return rows.select(*AXES, F.when(F.col("near_") == 0, F.lit(-1)).otherwise(F.col(label)).cast("long").alias(label))


def split_masks(labels_: DataFrame, label: str, options: list[str]) -> DataFrame:
    """``target, z, y, x, value``: the binary masks of several options in one scan."""
    masks = F.array(*(F.struct(F.lit(k).alias("target"), binary(F.col(label), o).cast("int").alias("value")) for k, o in enumerate(options)))
    return labels_.select(F.explode(masks).alias("m"), *AXES).select("m.target", *AXES, "m.value")


def decoded_energy(levels: Column, mode: str = "max") -> Column:
    """An energy from scores of its levels (an array): the place of the greatest by their number, or the mean of the levels by softmax,
    where level k stands for (k - 1) / 10."""
    if mode == "max":
        return (F.array_position(levels, F.array_max(levels)) - 1) / F.size(levels)
    if mode != "mean":
        raise ValueError(f"unknown mode {mode}")
    weights = F.transform(levels, lambda v: F.exp(v - F.array_max(levels)))
    total = F.aggregate(weights, F.lit(0.0), lambda s, v: s + v)
    places = F.transform(weights, lambda v, k: v * (k - 1) / 10)
    return F.aggregate(places, F.lit(0.0), lambda s, v: s + v) / total


def blending_weights(cells: DataFrame, size: tuple[int, int, int], kind: str = "gaussian", sigma: float = 0.2, power: float = 1.5) -> DataFrame:
    """``z, y, x, weight`` of a window: ``gaussian`` falls with the distance from the middle, ``bump`` is flat there and falls at the faces."""
    if kind == "gaussian":
        places = [F.lit(0.0) if n == 1 else F.col(a) * F.lit(2.0 / (n - 1)) - 1 for a, n in zip(AXES, size)]
        square = sum((p * p for p in places), F.lit(0.0))
        return cells.select(*AXES, (F.lit(1e-4) + F.exp(-square / F.lit(2 * sigma * sigma))).alias("weight"))
    if kind != "bump":
        raise ValueError(f"unknown kind {kind}")
    places = [(F.col(a) + 1) / F.lit(float(n + 1)) for a, n in zip(AXES, size)]
    depth = sum((-F.pow(p * (1 - p), F.lit(-power)) for p in places), F.lit(0.0))
    deepest = sum(-((((n + 1) // 2) / (n + 1)) * (1 - ((n + 1) // 2) / (n + 1))) ** -power for n in size)
    return cells.select(*AXES, (F.lit(1e-4) + F.exp(depth - F.lit(deepest))).alias("weight"))


def signed_polarity(label: Column) -> Column:
    """1 for the sender's side (odd ids), -1 for the receiver's (even ids), 0 for background."""
    return F.when(label == 0, 0).when(label % 2 == 1, 1).otherwise(-1)


def facing_left(labels_: DataFrame, label: str) -> DataFrame:
    """``pair, turn``: whether a synapse's sending side lies, on average, further along x than its receiving side (sides are 2n-1 and 2n)."""
    pair = F.expr(f"cast(({label} + 1) div 2 as bigint)")
    mean = lambda odd: F.avg(F.when(F.col(label) % 2 == odd, F.col("x")))
    return labels_.where(F.col(label) > 0).groupBy(pair.alias("pair")).agg(F.coalesce(mean(1) > mean(0), F.lit(False)).alias("turn"))


def central_slices(labels_: DataFrame, label: str, foreground: Column) -> DataFrame:
    """``label, z``: of each label's slices with foreground the one nearest to the middle of its depth, the lower one on ties."""
    middle = labels_.where(F.col(label) != 0).groupBy(label).agg(((F.min("z") + F.max("z")) / 2).alias("mid_"))
    slices = labels_.where((F.col(label) != 0) & foreground).select(label, "z").distinct().join(middle, label)
    return slices.groupBy(label).agg(F.min(F.struct(F.abs(F.col("z") - F.col("mid_")).alias("d"), "z")).alias("b")).select(label, F.col("b.z").alias("z"))


def slope(points: DataFrame, key: str) -> DataFrame:
    """``key, degrees``: the direction of each group's points by the least-squares slope of y on x; 90 for a single column of points."""
    found = points.groupBy(key).agg(F.regr_slope(F.col("y").cast("double"), F.col("x").cast("double")).alias("s"))
    return found.select(key, F.when(F.col("s").isNull(), F.lit(90.0)).otherwise(F.degrees(F.atan("s"))).alias("degrees"))
