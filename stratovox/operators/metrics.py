"""Segmentation metrics over voxel pairs: one aggregation to pair counts, everything else on the counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contingency(volume: DataFrame, a: str, b: str, ignore_a: tuple[int, ...] = (0,), ignore_b: tuple[int, ...] = (0,)) -> DataFrame:
    """``(a, b, n)``: voxels of each pair of labels, without the ignored labels."""
    kept = volume
    for name, ignored in ((a, ignore_a), (b, ignore_b)):
        if ignored:
            kept = kept.where(~F.col(name).isin(*ignored))
    return kept.groupBy(a, b).agg(F.count("*").alias("n"))


def _sums(counts: DataFrame, kind: str) -> DataFrame:
    n = F.col("n").cast("double")
    return counts.agg(F.sum(n * n).alias("sq"), F.sum(n * F.log2(n)).alias("nlog"), F.sum(n).alias("total")).select(F.lit(kind).alias("kind"), "*")


def rand_and_information(counts: DataFrame, truth: str, found: str) -> DataFrame:
    """Rand and information split and merge scores of pair counts, in one row."""
    parts = _sums(counts, "st").unionByName(_sums(counts.groupBy(truth).agg(F.sum("n").alias("n")), "t")).unionByName(_sums(counts.groupBy(found).agg(F.sum("n").alias("n")), "s"))
    of = lambda c, kind: F.max(F.when(F.col("kind") == kind, F.col(c)))
    entropy = lambda kind: F.log2(of("total", kind)) - of("nlog", kind) / of("total", kind)
    return parts.agg(
        (of("sq", "st") / of("sq", "t")).alias("rand_split"), (of("sq", "st") / of("sq", "s")).alias("rand_merge"),
        (entropy("st") - entropy("t")).alias("voi_split"), (entropy("st") - entropy("s")).alias("voi_merge"),
    )


def adapted_rand(volume: DataFrame, truth: str, found: str) -> DataFrame:
    """Adapted Rand error, precision and recall; unsegmented voxels count as singletons."""
    counts = volume.groupBy(truth, found).agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    inner = counts.where(F.col(truth) != 0)
    rows = (
        inner.groupBy(truth).agg(F.sum(n).alias("n")).agg(F.sum(n * n).alias("v")).select(F.lit("a").alias("k"), "v")
        .union(inner.where(F.col(found) != 0).groupBy(found).agg(F.sum(n).alias("n")).agg(F.sum(n * n).alias("v")).select(F.lit("b"), "v"))
        .union(inner.where(F.col(found) != 0).agg(F.sum(n * n)).select(F.lit("ab"), "*"))
        .union(inner.where(F.col(found) == 0).agg(F.sum(n)).select(F.lit("c"), "*"))
        .union(counts.agg(F.sum(n)).select(F.lit("n"), "*"))
    )
    of = lambda kind: F.coalesce(F.max(F.when(F.col("k") == kind, F.col("v"))), F.lit(0.0))
    single = of("c") / of("n")
    sums = rows.agg(((of("ab") + single) / (of("b") + single)).alias("precision"), ((of("ab") + single) / of("a")).alias("recall"))
    return sums.select((1 - 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).alias("are"), "precision", "recall")


def overlaps(counts: DataFrame, a: str, b: str) -> DataFrame:
    """Pair counts with both totals and the three overlap criteria."""
    ta, tb = F.sum("n").over(_by(a)), F.sum("n").over(_by(b))
    out = counts.select(a, b, "n", ta.alias("total_a"), tb.alias("total_b"))
    n = F.col("n").cast("double")
    return out.select(
        a, b, "n", "total_a", "total_b", (n / (F.col("total_a") + F.col("total_b") - F.col("n"))).alias("iou"), (n / F.col("total_a")).alias("iot"), (n / F.col("total_b")).alias("iop")
    )


def _by(column: str):
    from pyspark.sql import Window

    return Window.partitionBy(column)


def _matched(pairs: DataFrame, truth: str, found: str, threshold: float) -> DataFrame:
    """The overlaps of matched pairs. Above one half no object has two partners; below, groups of overlapping objects are assigned one to one."""
    if threshold > 0.5:
        return pairs.where(F.col("iou") >= threshold).select("iou")
    from stratovox.operators.components import components
    from stratovox.operators.kernels import assigned

    edges = pairs.select((2 * F.col(truth)).alias("a"), (2 * F.col(found) + 1).alias("b"))
    roots = components(edges).select(F.col("node").alias("n_"), "root")
    named = pairs.withColumn("n_", 2 * F.col(truth)).join(roots, "n_", "left").withColumn("group", F.coalesce("root", "n_"))
    return assigned(named.select("group", F.col(truth).cast("long").alias("a"), F.col(found).cast("long").alias("b"), "iou"), threshold).select("iou")


def matching(volume: DataFrame, truth: str, found: str, threshold: float = 0.75) -> DataFrame:
    """Instance matching of labels at an overlap, in one row; at one half or less by the best one-to-one assignment."""
    counts = volume.groupBy(truth, found).agg(F.count("*").alias("n"))
    pairs = overlaps(counts, truth, found).where((F.col(truth) != 0) & (F.col(found) != 0))
    sides = (
        _matched(pairs, truth, found, threshold).select(F.lit("p").alias("k"), "iou")
        .union(counts.where(F.col(truth) != 0).select(truth).distinct().select(F.lit("t"), F.lit(None).cast("double")))
        .union(counts.where(F.col(found) != 0).select(found).distinct().select(F.lit("f"), F.lit(None).cast("double")))
    )
    row = sides.agg(
        F.count("iou").alias("tp"), F.coalesce(F.sum("iou"), F.lit(0.0)).alias("score"), F.count(F.when(F.col("k") == "t", 1)).alias("n_true"), F.count(F.when(F.col("k") == "f", 1)).alias("n_pred")
    )
    tp = F.col("tp").cast("double")
    guarded = lambda x: F.when(F.col("tp") > 0, x).otherwise(F.lit(0.0))
    return row.select(
        "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_true") - F.col("tp")).alias("fn"), "n_true", "n_pred",
        guarded(tp / F.col("n_pred")).alias("precision"), guarded(tp / F.col("n_true")).alias("recall"),
        guarded(tp / (F.col("n_pred") + F.col("n_true") - F.col("tp"))).alias("accuracy"), guarded(2 * tp / (F.col("n_pred") + F.col("n_true"))).alias("f1"),
        guarded(F.col("score") / F.col("n_true")).alias("mean_true_score"), guarded(F.col("score") / tp).alias("mean_matched_score"),
        guarded(F.col("score") / ((F.col("n_pred") + F.col("n_true")) / 2)).alias("panoptic_quality"),
    )


def jaccard(volume: DataFrame, score: Column, truth: Column, thresholds: list[float]) -> DataFrame:
    """Foreground and mean overlap, precision and recall of a score above each threshold; a scan and one aggregation."""
    hit, t = F.col("p") > F.col("threshold"), F.col("t")
    rows = volume.select(score.alias("p"), truth.alias("t"), F.explode(F.array(*map(F.lit, thresholds))).alias("threshold"))
    sums = rows.groupBy("threshold").agg(*(F.count(F.when(c, 1)).cast("double").alias(k) for k, c in (("tp", hit & t), ("fp", hit & ~t), ("fn", ~hit & t), ("tn", ~hit & ~t))))
    iou, back = F.expr("tp / (tp + fp + fn)"), F.expr("tn / (tn + fp + fn)")
    return sums.select("threshold", iou.alias("fg_iou"), ((iou + back) / 2).alias("mean_iou"), F.expr("tp / (tp + fp)").alias("precision"), F.expr("tp / (tp + fn)").alias("recall"))


def losses(volume: DataFrame, p: Column, t: Column, smooth: float = 1.0) -> DataFrame:
    """Dice, squared, absolute and cross-entropy losses as aggregates, in one row."""
    rows = volume.select(p.alias("p"), t.cast("double").alias("t"))
    inside = F.least(F.greatest(F.col("p"), F.lit(1e-6)), F.lit(1 - 1e-6))
    return rows.agg(
        (1 - (2 * F.sum(F.col("p") * F.col("t")) + smooth) / (F.sum(F.col("p") * F.col("p")) + F.sum(F.col("t") * F.col("t")) + smooth)).alias("dice"),
        F.avg((F.col("p") - F.col("t")) * (F.col("p") - F.col("t"))).alias("mse"), F.avg(F.abs(F.col("p") - F.col("t"))).alias("mae"),
        F.avg(-(F.col("t") * F.log(inside) + (1 - F.col("t")) * F.log(1 - inside))).alias("bce"),
    )
