"""Queries over a volume with holes: rows outside of the mask are missing, and a missing row is background.

The SQL of each keeps all rows and sets what lies outside of the mask to 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import decoders, labels, regions, stencils
from stratovox.plans.regions import _boxed
from stratovox.plans.registry import query
from stratovox.sources.volumes import dense, region, voxels

_H = ", h as (select z, y, x, case when msk then gt else 0 end as gt, case when msk then img else 0 end as img, case when msk then seg % 9 else 0 end as s, cast(msk and img > 0.3::double as integer) as n, msk::integer as m from voxels)"


def _holed(spark, sf_dir):
    v = voxels(spark, sf_dir).where("msk")
    return v.select("z", "y", "x", "gt", "img", F.expr("seg % 9").alias("s"), (F.col("img") > 0.3).cast("int").alias("n"), F.lit(1).alias("m"))


_LAGS = ", ".join(f"lag(gt) over (partition by {', '.join(b for b in 'zyx' if b != a)} order by {a}) as o{a}" for a in "zyx")
_F = _H + f", l as (select *, {_LAGS} from h), f as (select least(gt, o) as u, greatest(gt, o) as v, img as aff from (" + " union all ".join(f"select gt, o{a} as o, img from l" for a in "zyx") + ") where gt <> 0 and o <> 0 and gt <> o)"


@query("holes_rag", _F + " select u, v, max(aff) as max, min(aff) as min, count(*) as contact from f group by u, v")
def holes_rag(spark, sf_dir):
    return regions.graph(regions.faces(_holed(spark, sf_dir), "gt", {a: "img" for a in "zyx"}), "max", "min", "contact")


def _dense(spark, sf_dir, *columns):
    """The holed volume as it is, for operators that fill it themselves."""
    return _holed(spark, sf_dir).select("z", "y", "x", *columns)


def _before(a, d=1):
    return f"lag(s, {d}) over (partition by {', '.join(b for b in 'zyx' if b != a)} order by {a})"


@query("holes_affinity", _H + "select z, y, x, " + ", ".join(f"cast(coalesce({_before(a)}, s) = s and s > 0 as integer) as aff_{a}" for a in "zyx") + " from h")
def holes_affinity(spark, sf_dir):
    return stencils.affinities(_dense(spark, sf_dir, "s"), "s")


_EDGE = ", e as (select z, y, x, cast(" + " or ".join(f"coalesce(lag(gt) over ({w}), gt) <> coalesce(lead(gt) over ({w}), gt)" for w in ("partition by z, x order by y", "partition by z, y order by x")) + " as integer) as v from h)"
_B, _BL = _boxed("max", "v", "e", (0, 1, 1))


@query("holes_boundary", _H + _EDGE + _B + f" select z, y, x, v as boundary from {_BL}")
def holes_boundary(spark, sf_dir):
    return stencils.boundaries(_dense(spark, sf_dir, "gt"), "gt", 1)


_D, _DL = _boxed("max", "s", "h", (1, 2, 2))


@query("holes_dilate", _H + _D + f" select z, y, x, s as label from {_DL}")
def holes_dilate(spark, sf_dir):
    return stencils.box(_dense(spark, sf_dir, "s"), "s", (1, 2, 2), "max", "label").select("z", "y", "x", "label")


_E, _EL = _boxed("sum", "m", "h", (1, 1, 1))


@query("holes_erode", _H + _E + f" select z, y, x, cast(m = 27 as integer) as eroded from {_EL}")
def holes_erode(spark, sf_dir):
    return stencils.eroded(_dense(spark, sf_dir, "m"), "m", (1, 1, 1), "eroded").select("z", "y", "x", "eroded")


_N, _NL = _boxed("sum", "n", "h", (1, 1, 1))


@query("holes_majority", _H + _N + f" select z, y, x, n * 2 > 27 as kept from {_NL}")
def holes_majority(spark, sf_dir):
    return stencils.majority(_dense(spark, sf_dir, "n"), F.col("n"), (1, 1, 1))


_V = _H + ", a0 as (select z, y, x, m as n, 1 as c from h)"
for _k, (_a, _w) in enumerate((("x", 6), ("y", 6), ("z", 2))):
    _over = f"over (partition by {', '.join(b for b in 'zyx' if b != _a)} order by {_a} rows between current row and {_w - 1} following)"
    _V += f", a{_k + 1} as (select z, y, x, sum(n) {_over} as n, sum(c) {_over} as c from a{_k})"


@query("holes_valid_windows", _V + " select z, y, x, cast(n as bigint) as n from a3 where c = 72 and n >= 0.8 * 72")
def holes_valid_windows(spark, sf_dir):
    return stencils.valid_windows(_dense(spark, sf_dir, "m"), F.col("m"), (2, 6, 6), 0.8)


@query("holes_filled", _H + "select z, y, x, gt, img from h where z < 2 and y >= 3 and y < 15 and x < 20")
def holes_filled(spark, sf_dir):
    box = region(_dense(spark, sf_dir, "gt", "img"), (0, 3, 0), (2, 15, 20))
    return dense(box, (0, 3, 0), (2, 15, 20))


def _reach(label, near):
    """SQL of connected components: what each voxel of ``w(i, l)`` reaches over its neighbours, by the least index."""
    return f""", w as (select *, z * 500 + y * 25 + x + 1 as i from {label} where l <> 0), e as (select a.i as i, b.i as j from w a join w b on b.l = a.l and {near}),
    reach(i, low) as (select i, i from w union select e.j, low from reach join e on e.i = reach.i where low < e.j), c as (select i, min(low) as component from reach group by i)"""


_FACES = "abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1"
_CORNERS = "abs(a.z - b.z) <= 1 and abs(a.y - b.y) <= 1 and abs(a.x - b.x) <= 1 and a.i <> b.i"


@query("holes_components", _H + ", t as (select z, y, x, n as l from h where x < 12)" + _reach("t", _FACES) + " select z, y, x, component from c join w using (i)")
def holes_components(spark, sf_dir):
    """Face-connected foreground of a part of the volume; the width of the volume names the components."""
    v = _dense(spark, sf_dir, "n").where("n = 1 and x < 12").withColumn("l", F.lit(1))
    return labels.grid_components(v, "l", (20, 25)).where("component <> 0")


@query("full_connected_components", ", t as (select z, y, x, 1 as l from voxels where img > 0.8::double)" + _reach("t", _CORNERS) + " select z, y, x, component from c join w using (i)")
def full_connected_components(spark, sf_dir):
    """Voxels above a threshold that touch by a face, an edge or a corner."""
    v = voxels(spark, sf_dir).where("img > 0.8").select("z", "y", "x", F.lit(1).alias("l"))
    return decoders.fully_connected(v, "l", (20, 25))
