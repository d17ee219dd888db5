"""Queries of instance decoders and of merging with composable statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import decoders, distances, grid, merging
from stratovox.plans.holes import _CORNERS, _reach
from stratovox.plans.metrics import rounded
from stratovox.plans.regions import _FACES as _EDGES
from stratovox.plans.regions import _faces
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels


def _blocks(spark, sf_dir, *columns):
    rows = grid.in_blocks(voxels(spark, sf_dir).select("z", "y", "x", *columns), (8, 8, 8), (0, 0, 0))
    return rows.withColumnRenamed("idx", "block")


def _block_faces(spark, sf_dir):
    return merging.block_faces(_blocks(spark, sf_dir, "seg", "img"), "seg", {a: "img" for a in "zyx"})


@query("foreground_above", "select z, y, x, cast(floor(img * 255) > 127 as integer) as fg from voxels")
def foreground_above(spark, sf_dir):
    """The threshold 0.5 of whole-number scores is cut to 127."""
    return voxels(spark, sf_dir).select("z", "y", "x", decoders.above(F.floor(F.col("img") * 255), 0.5).cast("int").alias("fg"))


@query("small_to_neighbours", """, v as (select z, y, x, case when seg % 11 = 3 then 1000 + y // 3 * 10 + x // 3 else gt end as l from voxels),
s as (select l, count(*) as n from v where l <> 0 group by l having count(*) < 40),
r as (select distinct v.z, v.y + dy as y, v.x + dx as x, v.l as own from v join s using (l), (select unnest(range(-1, 2)) as dy) a, (select unnest(range(-1, 2)) as dx) b where dy <> 0 or dx <> 0),
c as (select own, v.l, count(*) as n from r join v using (z, y, x) where v.l <> own group by all),
b as (select own, arg_max(l, (l <> 0, n, -l)) as new from c group by own)
select z, y, x, coalesce(new, l) as l from v left join b on own = l""")
def small_to_neighbours(spark, sf_dir):
    v = voxels(spark, sf_dir).select("z", "y", "x", F.expr("case when seg % 11 = 3 then 1000 + y div 3 * 10 + x div 3 else gt end").alias("l"))
    return decoders.given_to_neighbours(v, "l", 40)


_SYN = """, p as (select z, y, x, seg % 149 = 3 and x % 2 = 0 as a, seg % 149 = 3 and x % 2 = 1 as b from voxels), u as (select z, y, x, a, b, a or b as e from p),
g as (select distinct z, y + dy as y, x + dx as x from u, (select unnest(range(-1, 2)) as dy) k, (select unnest(range(-1, 2)) as dx) m where e and y + dy between 0 and 19 and x + dx between 0 and 24),
t as (select z, y, x, 1 as l from g)""" + _reach("t", _CORNERS) + """, n as (select z, y, x, dense_rank() over (order by component) as n from c join w using (i))
select u.z, u.y, u.x, cast(case when b then 2 * n when a then 2 * n - 1 else 0 end as bigint) as id from u left join n using (z, y, x)"""


@query("synapse_instances", _SYN)
def synapse_instances(spark, sf_dir):
    v = voxels(spark, sf_dir)
    some = F.col("seg") % 149 == 3  # few enough voxels that the SQL's components stay small
    a, b = some & (F.col("x") % 2 == 0), some & (F.col("x") % 2 == 1)
    return decoders.paired_synapses(v, a, b, a | b, reach=1)


@query("small_in_slices")
def small_in_slices(spark, sf_dir):
    """Parts of fewer than four voxels within slices across some axis; a test compares them with a flood fill."""
    v = voxels(spark, sf_dir).select("z", "y", "x", F.when(F.col("msk"), F.col("gt")).otherwise(F.lit(0)).alias("l"))
    return decoders.small_in_slices(v, "l", 4)


@query("side_distances", """, p as (select z * 3::double as z, y, x, img > 0.98::double as a, img < 0.01::double as b from voxels where img > 0.98::double or img < 0.01::double),
d as (select 0 as side, p.z, p.y, p.x, min(sqrt((p.z - q.z) * (p.z - q.z) + (p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))) as d from p, p q where p.a and q.b group by all
 union all select 1, p.z, p.y, p.x, min(sqrt((p.z - q.z) * (p.z - q.z) + (p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))) from p, p q where p.b and q.a group by all)
select cast(side as integer) as side, round(avg(d), 9) as mean, round(max(d), 9) as most, count(*) as n, count(*) filter (d > 8) as far from d group by side""")
def side_distances(spark, sf_dir):
    found = distances.side_distances(voxels(spark, sf_dir), F.col("img") > 0.98, F.col("img") < 0.01, (3.0, 1.0, 1.0), 8.0)
    return rounded(found.select("side", "mean", "most", "n", "far"))


@query("watershed_instances")
def watershed_instances(spark, sf_dir):
    """Every block's foreground flooded from its strongest parts; a test compares a block with a plain loop."""
    rows = _blocks(spark, sf_dir, "img")
    return decoders.watershed_instances(rows, "img", None, 0.5, 0.2, 0.0, 1)


@query("split_object")
def split_object(spark, sf_dir):
    """One label of every block cut at the waists of its shape; a test checks that parts are connected and cover the object."""
    return decoders.split_object(_blocks(spark, sf_dir, "gt"), "gt", 3, (1.0, 1.0, 1.0), 1000)


@query("rag_quantile", _EDGES + """, r as (select u, v, aff, row_number() over (partition by u, v order by aff) - 1 as r, count(*) over (partition by u, v) as n from f)
select u, v, aff as quantile from r where r = least((85 * n) // 100, n - 1)""")
def rag_quantile(spark, sf_dir):
    return merging.quantile_of_values(_faces(spark, sf_dir), ["u", "v"], "aff", 85)


@query("agglomerate_thresholds")
def agglomerate_thresholds(spark, sf_dir):
    """Merges of every block's regions at three rising thresholds by the histogram median; a test compares them with a plain loop."""
    return merging.agglomerated(_block_faces(spark, sf_dir), [0.5, 0.7, 0.9], "aff50_his256")


@query("agglomerate_quantile")
def agglomerate_quantile(spark, sf_dir):
    return merging.agglomerated(_block_faces(spark, sf_dir), [0.8], "aff85_his0")


@query("agglomerate_history")
def agglomerate_history(spark, sf_dir):
    return rounded(merging.merge_history(_block_faces(spark, sf_dir), 0.7, "max10"))


@query("agglomerate_graph")
def agglomerate_graph(spark, sf_dir):
    return rounded(merging.remaining_graph(_block_faces(spark, sf_dir), 0.7, "min"))


@query("segment_blocks")
def segment_blocks(spark, sf_dir):
    """Fragments of every block, merged by their boundaries; tests check fragments and merges by themselves."""
    return merging.segmented_blocks(_blocks(spark, sf_dir, "img"), {a: "img" for a in "zyx"}, 0.6)
