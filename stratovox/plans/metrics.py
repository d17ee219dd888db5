"""Queries of segmentation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import metrics
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels


def rounded(df, digits: int = 9):
    """Doubles to a fixed number of digits, so that engines that add in another order agree."""
    return df.select(*(F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes))


@query("vi_rand_metrics", """,
c as (select gt, seg, count(*) as n from voxels where gt <> 0 group by all),
t as (select cast(sum(n) as double) as n from c group by gt), s as (select cast(sum(n) as double) as n from c group by seg),
a as (select (select sum(cast(n as double) * n) from c) as st2, (select sum(n * n) from t) as t2, (select sum(n * n) from s) as s2,
  (select sum(cast(n as double)) from c) as total, (select sum(n * log2(cast(n as double))) from c) as lst, (select sum(n * log2(n)) from t) as lt, (select sum(n * log2(n)) from s) as ls)
select round(st2 / t2, 9) as rand_split, round(st2 / s2, 9) as rand_merge, round((lt - lst) / total, 9) as voi_split, round((ls - lst) / total, 9) as voi_merge from a""")
def vi_rand_metrics(spark, sf_dir):
    counts = metrics.contingency(voxels(spark, sf_dir), "gt", "seg", (0,), ())
    return rounded(metrics.rand_and_information(counts, "gt", "seg"))


@query("contingency_table", "select seg, gt, count(*) as n from voxels where seg <> 0 and gt <> 0 group by all")
def contingency_table(spark, sf_dir):
    return metrics.contingency(voxels(spark, sf_dir), "seg", "gt")


@query("adapted_rand_error", """,
c as (select gt, seg, count(*)::double as n from voxels group by all), i as (select * from c where gt <> 0),
v as (select (select sum(n * n) from (select sum(n) as n from i group by gt)) as a, (select sum(n * n) from (select sum(n) as n from i where seg <> 0 group by seg)) as b,
  (select sum(n * n) from i where seg <> 0) as ab, coalesce((select sum(n) from i where seg = 0), 0) / (select sum(n) from c) as single),
p as (select (ab + single) / (b + single) as p, (ab + single) / a as r from v)
select round(1 - 2 * p * r / (p + r), 9) as are, round(p, 9) as precision, round(r, 9) as recall from p""")
def adapted_rand_error(spark, sf_dir):
    return rounded(metrics.adapted_rand(voxels(spark, sf_dir), "gt", "seg"))


@query("binary_jaccard_thresholds", """,
r as (select img as p, gt % 2 = 1 as t, threshold from voxels, (select unnest([0.3::double, 0.5::double, 0.8::double]) as threshold)),
s as (select threshold, count(*) filter (p > threshold and t)::double as tp, count(*) filter (p > threshold and not t)::double as fp,
  count(*) filter (p <= threshold and t)::double as fn, count(*) filter (p <= threshold and not t)::double as tn from r group by threshold)
select threshold, round(tp / (tp + fp + fn), 9) as fg_iou, round((tp / (tp + fp + fn) + tn / (tn + fp + fn)) / 2, 9) as mean_iou, round(tp / (tp + fp), 9) as precision, round(tp / (tp + fn), 9) as recall from s""")
def binary_jaccard_thresholds(spark, sf_dir):
    return rounded(metrics.jaccard(voxels(spark, sf_dir), F.col("img"), F.expr("gt % 2 = 1"), [0.3, 0.5, 0.8]))


@query("overlap_iou_matrix", """,
c as (select gt, seg, count(*) as n from voxels group by all),
t as (select *, cast(sum(n) over (partition by gt) as bigint) as total_a, cast(sum(n) over (partition by seg) as bigint) as total_b from c)
select gt, seg, n, total_a, total_b, round(n::double / (total_a + total_b - n), 9) as iou, round(n::double / total_a, 9) as iot, round(n::double / total_b, 9) as iop from t""")
def overlap_iou_matrix(spark, sf_dir):
    return rounded(metrics.overlaps(metrics.contingency(voxels(spark, sf_dir), "gt", "seg", (), ()), "gt", "seg"))


_FOUND = "case when img < cast(0.05 as double) then 0 else gt end"


@query("instance_matching_iou75", f""",
c as (select gt, {_FOUND} as f, count(*) as n from voxels group by all),
t as (select *, sum(n) over (partition by gt) as ta, sum(n) over (partition by f) as tb from c),
m as (select n::double / (ta + tb - n)::double as iou from t where gt <> 0 and f <> 0),
a as (select count(*) filter (iou >= 0.75) as tp, coalesce(sum(iou) filter (iou >= 0.75), 0) as score,
  (select count(distinct gt) from c where gt <> 0) as n_true, (select count(distinct f) from c where f <> 0) as n_pred from m)
select tp, n_pred - tp as fp, n_true - tp as fn, n_true, n_pred, round(tp / n_pred, 9) as precision, round(tp / n_true, 9) as recall,
  round(tp / (n_pred + n_true - tp), 9) as accuracy, round(2 * tp / (n_pred + n_true), 9) as f1, round(score / n_true, 9) as mean_true_score,
  round(case when tp > 0 then score / tp else 0 end, 9) as mean_matched_score, round(score / ((n_pred + n_true) / 2), 9) as panoptic_quality from a""")
def instance_matching_iou75(spark, sf_dir):
    volume = voxels(spark, sf_dir).withColumn("found", F.when(F.col("img") < 0.05, 0).otherwise(F.col("gt")))
    return rounded(metrics.matching(volume, "gt", "found", 0.75))


@query("dice_mse_bce_metrics", """,
r as (select img as p, (gt % 2)::double as t, least(greatest(img, 1e-6::double), 1 - 1e-6::double) as q from voxels)
select round(1 - (2 * sum(p * t) + 1) / (sum(p * p) + sum(t * t) + 1), 9) as dice, round(avg((p - t) * (p - t)), 9) as mse, round(avg(abs(p - t)), 9) as mae,
  round(avg(-(t * ln(q) + (1 - t) * ln(1 - q))), 9) as bce from r""")
def dice_mse_bce_metrics(spark, sf_dir):
    return rounded(metrics.losses(voxels(spark, sf_dir), F.col("img"), F.expr("gt % 2")))


@query("segment_diff", f""",
c as (select gt as a, {_FOUND} as b, count(*) as n from voxels group by all),
t as (select *, sum(n) over (partition by a) as ta, sum(n) over (partition by b) as tb from c),
r as (select a, b, n::double / (ta + tb - n)::double as iou, row_number() over (partition by a order by n::double / (ta + tb - n)::double desc, b) as k from t where a <> 0 and b <> 0)
select a as id, b as best, round(iou, 9) as iou, iou >= 0.75 as shared from r where k = 1""")
def segment_diff(spark, sf_dir):
    volume = voxels(spark, sf_dir).withColumn("found", F.when(F.col("img") < 0.05, 0).otherwise(F.col("gt")))
    pairs = metrics.overlaps(metrics.contingency(volume, "gt", "found", (), ()), "gt", "found").where((F.col("gt") != 0) & (F.col("found") != 0))
    best = pairs.groupBy("gt").agg(F.max(F.struct("iou", (-F.col("found")).alias("m"))).alias("b"))
    return rounded(best.select(F.col("gt").alias("id"), (-F.col("b.m")).alias("best"), F.col("b.iou").alias("iou"), (F.col("b.iou") >= 0.75).alias("shared")))
