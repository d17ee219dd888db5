"""Queries of region graphs and stencils."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import augment, regions, stencils
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels

_FACES = """,
l as (select *, lag(gt) over (partition by y, x order by z) as oz, lag(gt) over (partition by z, x order by y) as oy, lag(gt) over (partition by z, y order by x) as ox from voxels),
f as (select least(gt, o) as u, greatest(gt, o) as v, img as aff from (select gt, oz as o, img from l union all select gt, oy, img from l union all select gt, ox, img from l)
      where gt <> 0 and o <> 0 and gt <> o)
"""


def _faces(spark, sf_dir):
    return regions.faces(voxels(spark, sf_dir), "gt", {a: "img" for a in "zyx"})


@query("rag_max", _FACES + "select u, v, max(aff) as max from f group by u, v")
def rag_max(spark, sf_dir):
    return regions.graph(_faces(spark, sf_dir), "max")


@query("rag_min", _FACES + "select u, v, min(aff) as min from f group by u, v")
def rag_min(spark, sf_dir):
    return regions.graph(_faces(spark, sf_dir), "min")


@query("rag_mean", _FACES + "select u, v, round(avg(aff), 9) as mean from f group by u, v")
def rag_mean(spark, sf_dir):
    return rounded(regions.graph(_faces(spark, sf_dir), "mean"))


@query("rag_contact_area", _FACES + "select u, v, count(*) as contact from f group by u, v")
def rag_contact_area(spark, sf_dir):
    return regions.graph(_faces(spark, sf_dir), "contact")


@query("rag_mean_max_k", _FACES + """, r as (select *, row_number() over (partition by u, v order by aff desc) as r from f)
select u, v, round(avg(aff), 9) as mean_max from r where r <= 10 group by u, v""")
def rag_mean_max_k(spark, sf_dir):
    return rounded(regions.mean_of_greatest(_faces(spark, sf_dir), 10))


_QUANTILE = """, c as (select {keys}, cast(least(floor({value} * 256), 255) as integer) as bin, count(*) as n from {source} group by all),
r as (select *, sum(n) over (partition by {keys} order by bin) as seen, sum(n) over (partition by {keys}) as total from c)
select {keys}, (min(bin) + 0.5::double) / 256::double as quantile from r where seen >= (50 * total) // 100 + 1 group by {keys}"""


@query("rag_hist_quantile", _FACES + _QUANTILE.format(keys="u, v", value="aff", source="f"))
def rag_hist_quantile(spark, sf_dir):
    return regions.histogram_quantile(_faces(spark, sf_dir), ["u", "v"], "aff", 50, 256)


@query("segment_hist_quantile", _QUANTILE.format(keys="seg", value="img", source="voxels"))
def segment_hist_quantile(spark, sf_dir):
    return regions.histogram_quantile(voxels(spark, sf_dir), ["seg"], "img", 50, 256)


@query("rag_min_max_size", _FACES + """, s as (select gt, count(*) as n from voxels where gt <> 0 group by gt), e as (select u, v, count(*) as contact from f group by u, v)
select u, v, contact, least(a.n, b.n) as min_size, greatest(a.n, b.n) as max_size from e join s a on a.gt = u join s b on b.gt = v""")
def rag_min_max_size(spark, sf_dir):
    return regions.with_sizes(regions.graph(_faces(spark, sf_dir), "contact"), regions.region_sizes(voxels(spark, sf_dir), "gt"))


@query("rag_score_expression", _FACES + """, e as (select u, v, max(aff) as mx, avg(aff) as mean, count(*) as contact from f group by u, v)
select u, v, round((1 - mx) * (mean * mean) + case when contact < 20 then 0 else 1 end, 9) as score from e""")
def rag_score_expression(spark, sf_dir):
    edges = regions.graph(_faces(spark, sf_dir), "max", "mean", "contact")
    score = (1 - F.col("max")) * F.col("mean") * F.col("mean") + regions.stepped(F.col("contact"), F.lit(20))
    return rounded(edges.select("u", "v", score.alias("score")))


@query("agglomerate_max_affinity", _FACES + """, g as (select u, v from f group by u, v having 1 - max(aff) < 0.0001::double), e as (select u as a, v as b from g union select v, u from g),
reach(node, label) as (select a, a from e union select e.b, reach.label from reach join e on e.a = reach.node where reach.label < e.b)
select node as id, min(label) as rep from reach group by node""")
def agglomerate_max_affinity(spark, sf_dir):
    edges = regions.graph(_faces(spark, sf_dir), "max").withColumn("score", 1 - F.col("max"))
    return regions.merged_below(edges, "score", 0.0001)


def _lags(d=(1, 1, 1), f="lag"):
    return tuple(f"{f}(s, {n}) over (partition by {', '.join(a for a in 'zyx' if a != axis)} order by {axis})" for axis, n in zip("zyx", d))


_S = ", v as (select z, y, x, seg % 9 as s from voxels)"
_AFF = lambda other: ", ".join(f"cast(case when {o} = s and s > 0 then 1 else 0 end as integer) as aff_{a}" for a, o in zip("zyx", other))


def _ninths(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", F.expr("seg % 9").alias("s"))


@query("affinity_v0", _S + "select z, y, x, " + _AFF([f"coalesce({x}, s)" for x in _lags()]) + " from v")
def affinity_v0(spark, sf_dir):
    return stencils.affinities(_ninths(spark, sf_dir), "s", filled=True)


_FIRST = [f"coalesce({x}, first_value(s) over (partition by {', '.join(b for b in 'zyx' if b != a)} order by {a}))" for a, x in zip("zyx", _lags((2, 3, 4)))]


@query("affinity_v1", _S + "select z, y, x, " + _AFF(_FIRST) + " from v")
def affinity_v1(spark, sf_dir):
    return stencils.clamped_affinities(_ninths(spark, sf_dir), "s", (2, 3, 4), filled=True)


@query("affinity_v2", _S + "select z, y, x, " + ", ".join(f"cast(coalesce({b} = {c} and {b} > 0, false) as integer) as aff_{a}" for a, b, c in zip("zyx", _lags(), _lags(f="lead"))) + " from v")
def affinity_v2(spark, sf_dir):
    return stencils.central_affinities(_ninths(spark, sf_dir), "s", (1, 1, 1), filled=True)


_OFFSETS = [(-1, 0, 0), (0, -1, 0), (0, 0, -1), (0, -3, -3)]


@query("affinity_offsets", _S + """, o(edge, oz, oy, ox) as (values (0, -1, 0, 0), (1, 0, -1, 0), (2, 0, 0, -1), (3, 0, -3, -3))
select edge, n.z, n.y, n.x, cast(n.s = f.s and n.s > 0 as integer) as aff from v n, o, v f where f.z = n.z + oz and f.y = n.y + oy and f.x = n.x + ox""")
def affinity_offsets(spark, sf_dir):
    return stencils.offset_affinities(_ninths(spark, sf_dir), "s", _OFFSETS, filled=True)


@query("boundary_from_affinity", _S + ", a as (select z, y, x, " + _AFF([f"coalesce({x}, s)" for x in _lags()]) + " from v) select z, y, x, round(1 - (aff_z + aff_y + aff_x) / 3::double, 9) as boundary from a")
def boundary_from_affinity(spark, sf_dir):
    aff = stencils.affinities(_ninths(spark, sf_dir), "s", filled=True)
    return rounded(aff.select("z", "y", "x", (1 - (F.col("aff_z") + F.col("aff_y") + F.col("aff_x")) / F.lit(3.0)).alias("boundary")))


def _boxed(how, column, source, reach):
    """SQL of a separable box, one table for each axis."""
    out, last = "", source
    for k, (axis, r) in enumerate(zip("xyz", reach[::-1])):
        by = ", ".join(a for a in "zyx" if a != axis)
        out += f", {source}{how}{k} as (select * exclude ({column}), {how}({column}) over (partition by {by} order by {axis} rows between {r} preceding and {r} following) as {column} from {last})"
        last = f"{source}{how}{k}"
    return out, last


_EDGE = """, e as (select z, y, x, cast(coalesce(lag(gt) over (partition by z, x order by y), gt) <> coalesce(lead(gt) over (partition by z, x order by y), gt)
  or coalesce(lag(gt) over (partition by z, y order by x), gt) <> coalesce(lead(gt) over (partition by z, y order by x), gt) as integer) as v from voxels)"""
_B, _L = _boxed("max", "v", "e", (0, 1, 1))


@query("instance_boundary", _EDGE + _B + f" select z, y, x, v as boundary from {_L}")
def instance_boundary(spark, sf_dir):
    return stencils.boundaries(voxels(spark, sf_dir), "gt", 1, filled=True)


_W = ", w as (select z, y, x, gt, gt as lo, gt as hi from voxels)"
_W1, _WL = _boxed("min", "lo", "w", (0, 1, 1))
_W2, _WH = _boxed("max", "hi", _WL, (0, 1, 1))


@query("widen_border", _W + _W1 + _W2 + f" select z, y, x, case when lo < hi then 0 else gt end as gt from {_WH}")
def widen_border(spark, sf_dir):
    return stencils.widened_border(voxels(spark, sf_dir), "gt", 1, filled=True)


_D, _DL = _boxed("max", "s", "v", (0, 2, 2))


@query("dilate_label", _S + _D + f" select z, y, x, s as label from {_DL}")
def dilate_label(spark, sf_dir):
    return stencils.box(_ninths(spark, sf_dir), "s", (0, 2, 2), "max", "label", filled=True).select("z", "y", "x", "label")


_M = ", m as (select z, y, x, cast(msk as integer) as n, cast(msk as integer) as g from voxels)"
_M1, _ML = _boxed("sum", "n", "m", (1, 1, 1))
_M2, _MH = _boxed("max", "g", _ML, (1, 1, 1))


@query("erode_dilate", _M + _M1 + _M2 + f" select z, y, x, cast(n = 27 as integer) as eroded, g as dilated from {_MH}")
def erode_dilate(spark, sf_dir):
    mask = voxels(spark, sf_dir).select("z", "y", "x", F.col("msk").cast("int").alias("m"))
    both = stencils.box(stencils.eroded(mask, "m", (1, 1, 1), "eroded", filled=True), "m", (1, 1, 1), "max", "dilated", filled=True)
    return both.select("z", "y", "x", "eroded", "dilated")


_J = ", j as (select z, y, x, cast(img > 0.3::double as integer) as n from voxels)"
_J1, _JL = _boxed("sum", "n", "j", (1, 1, 1))


@query("majority_filter", _J + _J1 + f" select z, y, x, n * 2 > 27 as kept from {_JL}")
def majority_filter(spark, sf_dir):
    return stencils.majority(voxels(spark, sf_dir), F.col("img") > 0.3, (1, 1, 1), filled=True)


_V = ", a0 as (select z, y, x, cast(msk as integer) as n, 1 as c from voxels)"
for _k, (_a, _w) in enumerate((("x", 8), ("y", 8), ("z", 2))):
    _by = ", ".join(b for b in "zyx" if b != _a)
    _over = f"over (partition by {_by} order by {_a} rows between current row and {_w - 1} following)"
    _V += f", a{_k + 1} as (select z, y, x, sum(n) {_over} as n, sum(c) {_over} as c from a{_k})"


@query("valid_windows", _V + " select z, y, x, cast(n as bigint) as n from a3 where c = 128 and n >= 0.8 * 128")
def valid_windows(spark, sf_dir):
    return stencils.valid_windows(voxels(spark, sf_dir), F.col("msk"), (2, 8, 8), 0.8)


@query("energy_quantize", ", e as (select z, y, x, img * 2 - 1 as v from voxels) select z, y, x, cast(case when v < 0 then 0 else least(floor(v * 10) + 1, 10) end as integer) as level from e")
def energy_quantize(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", stencils.quantised(F.col("img") * 2 - 1).alias("level"))


@query("blend_overlap_add", """, k as (select unnest(range(0, 3)) as k), p as (select z, y, cast(x + k - 1 as integer) as x, img - 0.05::double as value, 1.0::double / (1 + abs(k - 1)) as weight from voxels, k where x + k - 1 between 0 and 24)
select z, y, x, cast(floor(sum(greatest(value, 0) * weight) / sum(weight) * 255 + 1e-9) as integer) as value from p group by z, y, x""")
def blend_overlap_add(spark, sf_dir):
    patches = voxels(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(-1), F.lit(1))))
    patches = patches.select("z", "y", (F.col("x") + F.col("k")).alias("x"), (F.col("img") - 0.05).alias("value"), (F.lit(1.0) / (1 + F.abs("k"))).alias("weight"))
    return stencils.blended(patches.where("x between 0 and 24"))


@query("tta_reduce", """, t as (select z, y, x, img from voxels union all select z, 19 - y, x, img from voxels union all select z, y, 24 - x, img from voxels)
select z, cast(y as integer) as y, cast(x as integer) as x, round(avg(img), 9) as mean, least(1, min(img)) as low, greatest(0, max(img)) as high from t group by all""")
def tta_reduce(spark, sf_dir):
    found = augment.merged_flips(voxels(spark, sf_dir), "img", [(), ("y",), ("x",)])
    return rounded(found.select("z", "y", "x", "mean", F.least(F.lit(1.0), F.col("low")).alias("low"), F.greatest(F.lit(0.0), F.col("high")).alias("high")))
