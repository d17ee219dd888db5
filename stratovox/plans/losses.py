"""Queries of losses and regularisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import losses
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import query
from stratovox.sources.volumes import table, voxels

_L = """, l as (select z, y, x, img as p, img * 4 - 2 as a, 1 - img * 3 as b, (seg % 5)::double / 4 - 0.5::double as d, (gt % 2)::double as t, 1 + (seg % 3)::double as w, gt % 3 as k, msk::integer as m from voxels),
q as (select *, 1 / (1 + exp(-a)) as pa, 1 / (1 + exp(-b)) as pb, least(a, 0) - ln(1 + exp(-abs(a))) as la, least(-a, 0) - ln(1 + exp(-abs(a))) as na, tanh(d) as h from l)
"""


def _rows(spark, sf_dir):
    v = voxels(spark, sf_dir)
    whole = lambda e: F.expr(f"cast({e} as double)")
    return v.select("z", "y", "x", F.col("img").alias("p"), (F.col("img") * 4 - 2).alias("a"), (1 - F.col("img") * 3).alias("b"), (whole("seg % 5") / 4 - 0.5).alias("d"),
                    whole("gt % 2").alias("t"), (1 + whole("seg % 3")).alias("w"), F.expr("gt % 3").alias("k"), F.col("msk").cast("int").alias("m"))


@query("weighted_losses", _L + """select round(1 - (2 * sum(w * p * t) + 100) / (sum(w * p) + sum(w * t) + 100), 9) as dice, round(1 - (2 * sum(p * t) + 100) / (sum(p * p) + sum(t * t) + 100), 9) as dice_squared,
round(sum(w * (p - t) * (p - t)) / count(*), 9) as mse, round(sum(w * abs(p - t)) / count(*), 9) as mae, round(avg(-w * (least(greatest(t, 0.05), 0.95) * la + (1 - least(greatest(t, 0.05), 0.95)) * na)), 9) as bce,
round(avg(-(t * 0.25 + (1 - t) * 0.75) * pow(1 - (t * pa + (1 - t) * (1 - pa)), 2) * (t * la + (1 - t) * na)), 9) as focal from q""")
def weighted_losses(spark, sf_dir):
    p, t, w, a = (F.col(c) for c in "ptwa")
    return rounded(_rows(spark, sf_dir).agg(
        losses.dice(p, t, weight=w).alias("dice"), losses.dice(p, t, power=2).alias("dice_squared"), losses.squared(p, t, w).alias("mse"), losses.absolute(p, t, w).alias("mae"),
        losses.cross_entropy_of_logits(a, t, w, 0.05).alias("bce"), losses.focal(a, t).alias("focal"),
    ))


@query("class_cross_entropy", _L + """, e as (select k, greatest(a, b, d) + ln(exp(a - greatest(a, b, d)) + exp(b - greatest(a, b, d)) + exp(d - greatest(a, b, d))) - [a, b, d][k + 1] as e, [1.0::double, 2.0::double, 0.5::double][k + 1] as w from q)
select round(avg(e), 9) as plain, round(sum(w * e) / sum(w), 9) as weighted from e""")
def class_cross_entropy(spark, sf_dir):
    logits = [F.col(c) for c in "abd"]
    return rounded(_rows(spark, sf_dir).agg(losses.cross_entropy_of_classes(logits, F.col("k")).alias("plain"), losses.cross_entropy_of_classes(logits, F.col("k"), [1.0, 2.0, 0.5]).alias("weighted")))


@query("regularisers", _L + """select round(avg(m / greatest(abs(pa - 0.5), 0.01)), 9) as undecided, round(avg(-la * greatest(h, 0) + na * least(h, 0)), 9) as foreground_distance,
round(avg(m * pb * abs(h) * pb * abs(h)), 9) as contour_distance, round(avg(pa * pb / (1 + exp(-d))), 9) as overlap from q""")
def regularisers(spark, sf_dir):
    a, b, d, m = (F.col(c) for c in "abdm")
    return rounded(_rows(spark, sf_dir).agg(
        losses.undecided(a, m).alias("undecided"), losses.foreground_against_distance(a, d).alias("foreground_distance"),
        losses.contour_against_distance(b, d, m).alias("contour_distance"), losses.overlap_of_sides(a, b, d).alias("overlap"),
    ))


@query("contour_consistency", _L + """, s as (select z, y, x, pb as c, coalesce(lag(pa) over (partition by z, y order by x), 0) - coalesce(lead(pa) over (partition by z, y order by x), 0) as dx,
  coalesce(lag(pa) over (partition by z, x order by y), 0) - coalesce(lead(pa) over (partition by z, x order by y), 0) as dy from q),
e as (select z, y, x, c, greatest(least(sqrt(dx * dx + dy * dy + 1e-7::double), 1 - 1e-7::double), 1e-7::double) as e from s),
n as (select z, y, x, c, max(e) over (partition by z, y order by x rows between 1 preceding and 1 following) as e from e),
m as (select c, max(e) over (partition by z, x order by y rows between 1 preceding and 1 following) as e from n) select round(avg((e - c) * (e - c)), 9) as loss from m""")
def contour_consistency(spark, sf_dir):
    return rounded(losses.contour_against_edges(_rows(spark, sf_dir), "a", "b"))


@query("latent_divergence", """with e as (select vec_id, list_slice(embedding, 1, 32)::double[] as m, list_slice(embedding, 33, 64)::double[] as v from embeddings where embedding is not null)
select vec_id, round(-0.5 * list_sum(list_transform(range(1, 33), lambda i: 1 + v[i] - m[i] * m[i] - exp(v[i]))), 6) as kl from e""", voxels=False)
def latent_divergence(spark, sf_dir):
    halves = [F.slice(F.col("embedding").cast("array<double>"), k, 32) for k in (1, 33)]
    return rounded(table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", losses.divergence(*halves).alias("kl")), 6)


@query("running_means", """select event_id, round(sum(value::double * (1 + user_id % 4)) over w / sum(1 + user_id % 4) over w, 10) as mean from events
window w as (partition by event_id // 100 order by event_id rows between unbounded preceding and current row)""", voxels=False)
def running_means(spark, sf_dir):
    steps = table(spark, sf_dir, "events").select("event_id", F.col("value").cast("double").alias("value"), F.expr("1 + user_id % 4").alias("many"))
    return rounded(losses.running_mean(steps, "event_id", "value", "many", 100), 10)
