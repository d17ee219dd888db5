"""Queries of training targets and their options."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import crops, targets
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels

_S = ", v as (select z, y, x, seg % 9 as s from voxels)"


def _ninths(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", F.expr("seg % 9").alias("s"))


@query("binary_targets", """, t as (select 0 as target, z, y, x, cast(seg > 0 as integer) as value from voxels union all select 1, z, y, x, cast(seg in (3, 8, 11) as integer) from voxels)
select cast(target as integer) as target, z, y, x, value from t""")
def binary_targets(spark, sf_dir):
    return targets.split_masks(voxels(spark, sf_dir), "seg", ["0", "0-3-8-11"])


def _other(axis, d):
    by = ", ".join(b for b in "zyx" if b != axis)
    return f"{'lag' if d > 0 else 'lead'}(s, {abs(d)}) over (partition by {by} order by {axis})"


@query("affinity_directed", _S + "select z, y, x, " + ", ".join(f"cast(coalesce({_other(a, d)} = s and s > 0, false) as integer) as aff_{a}" for a, d in zip("zyx", (1, -2, 3))) + " from v")
def affinity_directed(spark, sf_dir):
    """A negative distance stores an edge at its lower voxel."""
    return targets.directed_affinities(_ninths(spark, sf_dir), "s", (1, -2, 3))


@query("affinity_by_option", _S + "select z, y, x, " + ", ".join(f"cast(coalesce({_other(a, d)} = s and s > 0, false) as integer) as aff_{a}" for a, d in zip("zyx", (1, 2, 2))) + " from v")
def affinity_by_option(spark, sf_dir):
    return targets.affinities(_ninths(spark, sf_dir), "s", "2-1-2-2-pni")


@query("affinity_dense_graph", _S + """, o(edge, oz, oy, ox) as (values (0, -1, 0, 0), (1, 0, -1, 0), (2, 0, 0, -1), (3, -1, -1, 0), (4, -1, 0, -1), (5, -1, 0, 1), (6, -1, 1, 0), (7, 0, -1, -1), (8, 0, -1, 1)),
k as (select row_number() over (order by oz, oy, ox) - 1 as edge, oz, oy, ox from o)
select cast(edge as integer) as edge, n.z, n.y, n.x, cast(n.s = f.s and n.s > 0 as integer) as aff from v n, k, v f where f.z = n.z + oz and f.y = n.y + oy and f.x = n.x + ox""")
def affinity_dense_graph(spark, sf_dir):
    """All edges of length up to the root of two."""
    from stratovox.operators import stencils

    return stencils.offset_affinities(_ninths(spark, sf_dir), "s", targets.half_ball(1.5))


@query("ignored_far", """, b as (select z, y, x, seg % 7 = 1 as f from voxels),
n as (select a.z, a.y, a.x, bool_or(coalesce(b.f, false)) as near from voxels a left join b on b.z = a.z and b.y between a.y - 2 and a.y + 2 and b.x between a.x - 2 and a.x + 2 group by all)
select z, y, x, case when not near then -1 when seg % 7 = 1 then 1 else 0 end::bigint as l from n join voxels using (z, y, x)""")
def ignored_far(spark, sf_dir):
    v = voxels(spark, sf_dir).select("z", "y", "x", F.expr("case when seg % 7 = 1 then 1 else 0 end").alias("l"))
    return targets.ignored_far(v, "l")


@query("decode_quantized", """, l as (select z, y, x, [img, abs(img - 0.5::double), 1 - img, img * img] as v from voxels),
w as (select z, y, x, v, list_max(v) as m, list_transform(v, lambda t: exp(t - list_max(v))) as e from l)
select z, y, x, round((list_position(v, m) - 1) / 4::double, 9) as hardest, round((e[1] * -0.1::double + e[3] * 0.1::double + e[4] * 0.2::double) / list_sum(e), 9) as mean from w""")
def decode_quantized(spark, sf_dir):
    v = voxels(spark, sf_dir).withColumn("v", F.array("img", F.abs(F.col("img") - 0.5), 1 - F.col("img"), F.col("img") * F.col("img")))
    return rounded(v.select("z", "y", "x", targets.decoded_energy(F.col("v")).alias("hardest"), targets.decoded_energy(F.col("v"), "mean").alias("mean")))


def _window(expression):
    return ", g as (select cast(a.z as integer) as z, cast(b.y as integer) as y, cast(c.x as integer) as x from (select unnest(range(0, (select max(z) + 1 from voxels))) as z) a, (select unnest(range(0, 9)) as y) b, (select unnest(range(0, 8)) as x) c), n as (select max(z) + 1 as nz from voxels) " + expression


@query("blend_gaussian", _window("""select z, y, x, round(1e-4::double + exp(-(pow(case when nz = 1 then 0 else z * 2::double / (nz - 1) - 1 end, 2) + pow(y * 2::double / 8 - 1, 2) + pow(x * 2::double / 7 - 1, 2)) / 0.08::double), 9) as weight from g, n"""))
def blend_gaussian(spark, sf_dir):
    size = (voxels(spark, sf_dir).agg(F.max("z") + 1).first()[0], 9, 8)
    return rounded(targets.blending_weights(crops.cells(spark, size), size))


@query("blend_bump", _window(""", d as (select z, y, x, -pow((z + 1)::double / (nz + 1) * (1 - (z + 1)::double / (nz + 1)), -1.5) - pow((y + 1)::double / 10 * (1 - (y + 1)::double / 10), -1.5) - pow((x + 1)::double / 9 * (1 - (x + 1)::double / 9), -1.5) as d from g, n)
select z, y, x, round(1e-4::double + exp(d - (select max(d) from d)), 9) as weight from d"""))
def blend_bump(spark, sf_dir):
    size = (voxels(spark, sf_dir).agg(F.max("z") + 1).first()[0], 9, 8)
    return rounded(targets.blending_weights(crops.cells(spark, size), size, "bump"))


@query("signed_polarity", "select z, y, x, cast(case when seg = 0 then 0 when seg % 2 = 1 then 1 else -1 end as integer) as sign from voxels")
def signed_polarity(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", targets.signed_polarity(F.col("seg")).alias("sign"))


@query("facing_left", "select (seg + 1) // 2 as pair, coalesce(avg(x) filter (seg % 2 = 1) > avg(x) filter (seg % 2 = 0), false) as turn from voxels where seg > 0 group by all")
def facing_left(spark, sf_dir):
    return targets.facing_left(voxels(spark, sf_dir), "seg")


@query("central_slices", """, m as (select seg, (min(z) + max(z)) / 2::double as mid from voxels where seg <> 0 group by seg),
s as (select distinct seg, z, abs(z - mid) as d from voxels join m using (seg) where seg <> 0 and msk)
select seg, cast(arg_min(z, (d, z)) as integer) as z from s group by seg""")
def central_slices(spark, sf_dir):
    return targets.central_slices(voxels(spark, sf_dir), "seg", F.col("msk"))


@query("contact_directions", "select seg, round(coalesce(degrees(atan(regr_slope(y, x))), 90), 6) as degrees from voxels where seg <> 0 group by seg")
def contact_directions(spark, sf_dir):
    return rounded(targets.slope(voxels(spark, sf_dir).where("seg <> 0"), "seg"), 6)
