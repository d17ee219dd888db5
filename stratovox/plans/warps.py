"""Queries of interpolating resampling and warps, of weights between objects, and of flows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from stratovox.operators import dispatch, objects, warps
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import components_sql, query
from stratovox.sources.volumes import voxels

_N = ", n as (select max(z) + 1 as nz from voxels), g as (select z, y, x from n, unnest(range(0, nz)) a(z), unnest(range(0, 20)) b(y), unnest(range(0, 25)) c(x))"


def _gather(places):
    """SQL of linear interpolation at the places of ``s(z, y, x, sz, sy, sx)``."""
    return places + """, k as (select z, y, x, floor(sz) + a as cz, floor(sy) + b as cy, floor(sx) + c as cx,
    (case when a = 1 then sz - floor(sz) else 1 - (sz - floor(sz)) end) * (case when b = 1 then sy - floor(sy) else 1 - (sy - floor(sy)) end) * (case when c = 1 then sx - floor(sx) else 1 - (sx - floor(sx)) end) as w
    from s, unnest([0, 1]) i(a), unnest([0, 1]) j(b), unnest([0, 1]) l(c))
    select k.z, k.y, k.x, round(coalesce(sum(w * img), 0), 9) as img from k left join voxels v on v.z = cz and v.y = cy and v.x = cx group by all"""


_COS, _SIN = math.cos(math.radians(30.0)), math.sin(math.radians(30.0))
_TURNED = _N + f", s as (select z, y, x, z::double as sz, (y - 9.5::double) * {_COS!r}::double - (x - 12::double) * {_SIN!r}::double + 9.5::double as sy, (y - 9.5::double) * {_SIN!r}::double + (x - 12::double) * {_COS!r}::double + 12::double as sx from g)"


@query("resize_linear", _gather(", n as (select max(z) + 1 as nz from voxels), s as (select z, y, x, case when nz = 1 then 0 else z * (nz - 1)::double / (greatest(floor(nz * 1.5 + 0.5), 1) - 1)::double end as sz, y * 19::double / 12::double as sy, x * 24::double / 39::double as sx from n, unnest(range(0, cast(floor(nz * 1.5 + 0.5) as bigint))) a(z), unnest(range(0, 13)) b(y), unnest(range(0, 40)) c(x))"))
def resize_linear(spark, sf_dir):
    """More slices and columns, fewer rows, linear along each axis."""
    return rounded(warps.resized_linear(voxels(spark, sf_dir), "img", factor=(1.5, 0.65, 1.6)))


@query("rotated_volume", _gather(_TURNED))
def rotated_volume(spark, sf_dir):
    return rounded(warps.rotated(voxels(spark, sf_dir), "img", 30.0))


@query("rotated_labels", _TURNED + " select s.z, s.y, s.x, coalesce(gt, 0) as gt from s left join voxels v on v.z = s.z and v.y = floor(sy + 0.5::double) and v.x = floor(sx + 0.5::double)")
def rotated_labels(spark, sf_dir):
    return warps.rotated(voxels(spark, sf_dir), "gt", 30.0, linear=False)


@query("rescaled_volume", _gather(_N + ", s as (select z, y, x, z::double as sz, (y - 9.5::double) * 0.8::double + 9.5::double as sy, (x - 12::double) * 0.8::double + 12::double as sx from g)"))
def rescaled_volume(spark, sf_dir):
    return rounded(warps.rescaled(voxels(spark, sf_dir), "img", 1.25))


@query("elastic_volume", _gather(_N + ", s as (select z, y, x, z::double as sz, least(greatest(y + 1.5::double * sin(x / 5::double), 0), 19) as sy, least(greatest(x + 0.75::double * cos(y / 4::double + z), 0), 24) as sx from g)"))
def elastic_volume(spark, sf_dir):
    """A fixed displacement field; places beyond the border take the border's voxels."""
    field = {"y": 1.5 * F.sin(F.col("x") / F.lit(5.0)), "x": 0.75 * F.cos(F.col("y") / F.lit(4.0) + F.col("z"))}
    return rounded(warps.displaced(voxels(spark, sf_dir), "img", field, clamp=True))


_OBJECTS = ", o as (select z, y, x, case when img > 0.85::double then seg % 7 else 0 end as l from voxels)"


@query("border_weights", _OBJECTS + """, d as (select a.z, a.y, a.x, b.l, min((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) as d from o a join o b on a.z = b.z and b.l <> 0 group by all),
r as (select z, y, x, sqrt(d) as d, row_number() over (partition by z, y, x order by d) as r from d), t as (select z, y, x, max(d) filter (r = 1) as a, max(d) filter (r = 2) as b from r group by all)
select z, y, x, round(least(greatest(case when l <> 0 then 5 else coalesce(10 * exp(-((a + b) * (a + b)) / 8::double), 1) end, 1), 10), 9) as weight from o left join t using (z, y, x)""")
def border_weights(spark, sf_dir):
    v = voxels(spark, sf_dir).select("z", "y", "x", F.when(F.col("img") > 0.85, F.col("seg") % 7).otherwise(F.lit(0)).alias("l"))
    return rounded(objects.border_weights(v, "l", sigma=2.0))


@query("object_flows")
def object_flows(spark, sf_dir):
    """Flows of every object of every slice; a test compares them with a plain loop over whole slices."""
    return rounded(objects.flows(voxels(spark, sf_dir).select("z", "y", "x", "gt"), "gt"), 6)


#: Few labels with holes, in pieces.
_PIECES = """, o as (select z, y, x, z * 500 + y * 25 + x + 1 as i, case when img > 0.75::double then 0 else 1 + seg % 3 end as l from voxels)"""
_SLICE_DISTANCE = """, {name} as (select a.z, a.y, a.x, a.{own}, min(sqrt((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))) as d from {table} a join {table} b on a.z = b.z and {other} group by all)"""
_TARGETS = _PIECES + ", w as (select i, z, y, x, l * 1000000 + z as l from o where l <> 0)" + components_sql("w") + ", p as (select o.z, o.y, o.x, l, coalesce(low, 0) as part from o left join reach using (i))"
_TARGETS += _SLICE_DISTANCE.format(name="dp", own="part", table="p", other="a.part <> 0 and a.part <> b.part") + ", mp as (select part, max(d) + 1e-6::double as m from dp group by part)"
_TARGETS += _SLICE_DISTANCE.format(name="df", own="l", table="o", other="(a.l = 0) <> (b.l = 0)")
_TARGETS += """, t as (select 0 as target, 0 as channel, z, y, x, (l > 0)::integer::double as value from o union all select 0 + 1, c, z, y, x, case c when 0 then l in (1, 3) when 1 then l = 2 else l > 0 end::integer::double from o, unnest(range(0, 3)) u(c)
union all select 2, 0, z, y, x, case when l = 0 then 0 when l % 2 = 1 then 1 else 2 end from o union all select 3, 0, p.z, p.y, p.x, coalesce(d / m, -1) from p left join dp using (z, y, x, part) left join mp using (part)
union all select 4, 0, o.z, o.y, o.x, tanh(case when l <> 0 then d / 8 else -d / 50 end) from o join df using (z, y, x, l) union all select 5, 0, z, y, x, l from o)
select target, cast(channel as integer) as channel, z, y, x, round(value::double, 9) as value from t"""


@query("targets_by_options", _TARGETS)
def targets_by_options(spark, sf_dir):
    """Six targets of one volume: foreground, both forms of polarity, object and semantic distances, and the label."""
    v = voxels(spark, sf_dir).where("img <= 0.75").select("z", "y", "x", F.expr("1 + seg % 3").alias("l"))
    return rounded(dispatch.to_targets(v, "l", ["0", "1", "1-1", "5-2d-0-0-1.0-0", "6-2d-8-50", "9"]))
