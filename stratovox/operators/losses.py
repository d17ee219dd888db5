"""Losses, regularisers and running means as aggregates: every voxel is one row, so any volume is one partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators import stencils
from stratovox.operators.stencils import before
from stratovox.sources.volumes import AXES, dense


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def log_sigmoid(logit: Column) -> Column:
    """log(sigmoid), without overflow on either side."""
    return F.least(logit, F.lit(0.0)) - F.log1p(F.exp(-F.abs(logit)))


def dice(prediction: Column, target: Column, power: int = 1, smooth: float = 100.0, weight: Column | None = None) -> Column:
    """1 - (2 overlap + smooth) / (sums of powers + smooth); with weights every sum is weighted."""
    w = F.lit(1.0) if weight is None else weight
    raised = lambda c: c if power == 1 else F.pow(c, F.lit(float(power)))
    return 1 - (2 * F.sum(w * prediction * target) + smooth) / (F.sum(w * raised(prediction)) + F.sum(w * raised(target)) + smooth)


def squared(prediction: Column, target: Column, weight: Column | None = None) -> Column:
    w = F.lit(1.0) if weight is None else weight
    return F.sum(w * (prediction - target) * (prediction - target)) / F.count(F.lit(1))


def absolute(prediction: Column, target: Column, weight: Column | None = None) -> Column:
    w = F.lit(1.0) if weight is None else weight
    return F.sum(w * F.abs(prediction - target)) / F.count(F.lit(1))


def cross_entropy_of_logits(logit: Column, target: Column, weight: Column | None = None, smoothing: float = 0.0) -> Column:
    """Binary cross entropy of logits; ``smoothing`` keeps targets that far from 0 and 1."""
    t = F.least(F.greatest(target, F.lit(smoothing)), F.lit(1 - smoothing))
    w = F.lit(1.0) if weight is None else weight
    return F.avg(-w * (t * log_sigmoid(logit) + (1 - t) * log_sigmoid(-logit)))


def cross_entropy_of_classes(logits: list[Column], target: Column, class_weights: list[float] | None = None) -> Column:
    """Cross entropy of several classes; with class weights the mean is weighted by those of the targets."""
    weights = class_weights or [1.0] * len(logits)
    most = F.greatest(*logits) if len(logits) > 1 else logits[0]
    total = most + F.log(sum((F.exp(v - most) for v in logits), F.lit(0.0)))
    own = F.element_at(F.array(*logits), target.cast("int") + 1)
    w = F.element_at(F.array(*map(F.lit, weights)), target.cast("int") + 1)
    return F.sum(w * (total - own)) / F.sum(w)


def focal(logit: Column, target: Column, gamma: float = 2.0, alpha: float = 0.25) -> Column:
    """Cross entropy in which well-recognised voxels count little."""
    p = sigmoid(logit)
    right = target * p + (1 - target) * (1 - p)
    share = target * alpha + (1 - target) * (1 - alpha)
    log_right = target * log_sigmoid(logit) + (1 - target) * log_sigmoid(-logit)
    return F.avg(-share * F.pow(1 - right, F.lit(gamma)) * log_right)


def undecided(logit: Column, mask: Column | None = None) -> Column:
    """Mean of the inverse distance of probabilities from one half, which is taken as 0.01 at least."""
    m = F.lit(1.0) if mask is None else mask
    return F.avg(m / F.greatest(F.abs(sigmoid(logit) - 0.5), F.lit(1e-2)))


def foreground_against_distance(logit: Column, distance: Column, mask: Column | None = None) -> Column:
    """Foreground where the signed distance is negative, and background where it is positive."""
    m, d = F.lit(1.0) if mask is None else mask, F.tanh(distance)
    return F.avg(m * (-log_sigmoid(logit) * F.greatest(d, F.lit(0.0)) + log_sigmoid(-logit) * F.least(d, F.lit(0.0))))


def contour_against_distance(logit: Column, distance: Column, mask: Column | None = None) -> Column:
    """Contours that lie away from the zero of the signed distance."""
    m, v = F.lit(1.0) if mask is None else mask, sigmoid(logit) * F.abs(F.tanh(distance))
    return F.avg(m * v * v)


def overlap_of_sides(sender: Column, receiver: Column, cleft: Column | None = None) -> Column:
    """Both sides of a synapse at one place, weighted by the cleft's probability if given."""
    v = sigmoid(sender) * sigmoid(receiver)
    return F.avg(v * sigmoid(cleft) if cleft is not None else v)


def contour_against_edges(volume: DataFrame, foreground: str, contour: str, reach: int = 1) -> DataFrame:
    """``loss``: squared difference of contour probabilities and the foreground's edges: central differences along x and y (0 outside),
    their length between 1e-7 and its complement, and the greatest of those within ``reach`` in the slice."""
    rows = dense(volume.select(*AXES, foreground, contour))
    probability = rows.select(*AXES, sigmoid(F.col(foreground)).alias("p"), sigmoid(F.col(contour)).alias("c"))
    step = lambda a: F.coalesce(before("p", a), F.lit(0.0)) - F.coalesce(before("p", a, -1), F.lit(0.0))
    edges = probability.select(*AXES, "c", step("x").alias("dx"), step("y").alias("dy"))
    length = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + 1e-7)
    edges = edges.select(*AXES, "c", F.greatest(F.least(length, F.lit(1 - 1e-7)), F.lit(1e-7)).alias("e"))
    near = stencils.box(edges, "e", (0, reach, reach), "max", "near")
    return near.agg(F.avg((F.col("near") - F.col("c")) * (F.col("near") - F.col("c"))).alias("loss"))


def divergence(mean: Column, log_variance: Column) -> Column:
    """Divergence of a normal distribution from the standard one, of arrays of means and log variances."""
    each = F.zip_with(mean, log_variance, lambda m, v: 1 + v - m * m - F.exp(v))
    return F.aggregate(each, F.lit(0.0), lambda s, v: s + v) * -0.5


def running_mean(steps: DataFrame, order: str, value: str, many: str, reset_every: int) -> DataFrame:
    """``order, mean``: the mean of ``value``, weighted by ``many``, since the last reset; resets begin parts of their own, so parts run in parallel."""
    from pyspark.sql import Window

    part = F.floor(F.col(order) / reset_every)
    since = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return steps.select(order, (F.sum(F.col(value) * F.col(many)).over(since) / F.sum(many).over(since)).alias("mean"))
