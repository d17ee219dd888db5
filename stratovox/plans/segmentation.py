"""Queries of agglomeration, affinity watershed, distances and seeds, over blocks and whole volumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import agglomeration, distances, flooding, labels, merging, quantiles, regions, seeds, supervoxels, watershed
from stratovox.plans.decoders import _block_faces
from stratovox.plans.holes import _reach
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels

_BLOCK_LAGS = ", ".join(f"lag(seg) over (partition by block, {', '.join(b for b in 'zyx' if b != a)} order by {a}) as o{a}" for a in "zyx")


@query("agglomerate_blocks_max", f""", k as (select (z // 8 * 3 + y // 8) * 4 + x // 8 as block, z, y, x, seg, img from voxels), l as (select *, {_BLOCK_LAGS} from k),
f as (select block, least(seg, o) as u, greatest(seg, o) as v, img as aff from (select block, seg, img, unnest([oz, oy, ox]) as o from l) where seg <> 0 and o <> 0 and seg <> o),
g as (select block, u, v, 1 - max(aff) as s from f group by all), t as (select unnest([0.02::double, 0.1::double, 0.3::double]) as threshold),
e as (select threshold, block, u as a, v as b from g, t where s < threshold union all select threshold, block, v, u from g, t where s < threshold),
reach(threshold, block, node, low) as (select threshold, block, a, a from e union select e.threshold, e.block, e.b, low from reach r join e on e.threshold = r.threshold and e.block = r.block and e.a = r.node where low < e.b)
select block, threshold, node as id, min(low) as rep from reach group by all having min(low) < node""")
def agglomerate_blocks_max(spark, sf_dir):
    """Merging cheapest-first by the greatest affinity comes to the connected components of each block."""
    return merging.agglomerated(_block_faces(spark, sf_dir), [0.02, 0.1, 0.3], "max")


#: Cells of three voxels a side: regions that cross the borders of blocks.
_CELLS = """, c as (select z, y, x, cast(z // 3 * 63 + y // 3 * 9 + x // 3 + 1 as bigint) as cell, img from voxels),
l as (select *, lag(cell) over (partition by y, x order by z) as oz, lag(cell) over (partition by z, x order by y) as oy, lag(cell) over (partition by z, y order by x) as ox from c),
f as (select o as u, cell as v, img as aff from (select cell, img, unnest([oz, oy, ox]) as o from l) where cell <> o)"""


def _cell_edges(spark, sf_dir):
    cells = voxels(spark, sf_dir).select("z", "y", "x", F.expr("z div 3 * 63 + y div 3 * 9 + x div 3 + 1").alias("cell"), "img")
    return agglomeration.region_edges(regions.faces(cells, "cell", {a: "img" for a in "zyx"}))


@query("agglomerate_volume_max", _CELLS + """, g as (select u, v from f group by u, v having 1 - max(aff) < 0.01::double), e as (select u as a, v as b from g union all select v, u from g),
reach(node, low) as (select a, a from e union select e.b, low from reach join e on e.a = node where low < e.b)
select node as id, min(low) as rep from reach group by node having min(low) < node""")
def agglomerate_volume_max(spark, sf_dir):
    return agglomeration.agglomerated(_cell_edges(spark, sf_dir), 0.01, "max")


@query("agglomerate_volume_mean")
def agglomerate_volume_mean(spark, sf_dir):
    """A test compares the operator with a loop that looks for the cheapest pair after each merge."""
    return agglomeration.agglomerated(_cell_edges(spark, sf_dir), 0.55, "mean")


@query("agglomerate_volume_min")
def agglomerate_volume_min(spark, sf_dir):
    """As :func:`agglomerate_volume_mean`."""
    return agglomeration.agglomerated(_cell_edges(spark, sf_dir), 0.9, "min")


#: Affinities of seven levels, so that there are plateaus; edges to voxels outside count as 0.
_STEEPEST = """, q as (select z, y, x, z * 500 + y * 25 + x + 1 as i, floor(img * 6) / 6 as a from voxels), top as (select max(z) as nz from q),
n as (select i, d, j, a from (select i, 0 as d, i - 500 as j, a from q where z > 0 union all select i, 1, i - 25, a from q where y > 0 union all select i, 2, i - 1, a from q where x > 0
 union all select i - 500, 3, i, a from q where z > 0 union all select i - 25, 4, i, a from q where y > 0 union all select i - 1, 5, i, a from q where x > 0)),
m as (select i, max(a) as m from n group by i having max(a) > 0), s as (select n.i, d, j from n join m using (i) where a = m or a >= 1),
t as (select a.i, a.d, a.j from s a join s b on a.i = b.j and a.j = b.i), c as (select i, d, j from s anti join t using (i, d)),
hop(i, k) as (select distinct i, 0 from c union select t.j, k + 1 from hop join t using (i) where k < 60 and t.j not in (select i from c)),
lv as (select i, min(k) as k from hop group by i),
go as (select i, arg_max(j, d) as j from c group by i union all select t.i, arg_max(t.j, t.d) from t join lv a on a.i = t.i join lv b on b.i = t.j where a.k > 0 and b.k = a.k - 1 group by t.i),
w as (select i, j from go union select j, i from go union select i, j from t where i not in (select i from lv) and j not in (select i from lv)),
basin(i, low) as (select i, i from m union select w.j, low from basin join w using (i) where low < w.j), b as (select i, min(low) as basin from basin group by i)"""


def _levels(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", (F.floor(F.col("img") * 6) / 6).alias("a"))


@query("affinity_watershed", _STEEPEST + " select z, y, x, coalesce(basin, 0) as basin from q left join b using (i)")
def affinity_watershed(spark, sf_dir):
    return watershed.affinity_watershed(_levels(spark, sf_dir), {a: "a" for a in "zyx"}, 0.0, 1.0, (20, 25))


@query("affinity_basins_numbered", _STEEPEST + ", r as (select basin, row_number() over (order by basin) as id from (select distinct basin from b)) select z, y, x, coalesce(id, 0) as basin from q left join b using (i) left join r using (basin)")
def affinity_basins_numbered(spark, sf_dir):
    """Basins numbered in the order of their first voxels."""
    return labels.compacted(affinity_watershed(spark, sf_dir), "basin")


@query("segment_volume_max", _STEEPEST + """, f as (select least(p.basin, o.basin) as u, greatest(p.basin, o.basin) as v, a from n join b p on p.i = n.i join b o on o.i = n.j where d < 3 and p.basin <> o.basin),
g as (select u, v from f group by u, v having 1 - max(a) < 0.4::double), e as (select u as k, v as h from g union all select v, u from g),
reach(k, low) as (select distinct basin, basin from b union select e.h, low from reach join e using (k) where low < e.h), r as (select k as basin, min(low) as id from reach group by k)
select z, y, x, coalesce(id, 0) as id from q left join b using (i) left join r using (basin)""")
def segment_volume_max(spark, sf_dir):
    return agglomeration.segmented_volume(_levels(spark, sf_dir), {a: "a" for a in "zyx"}, 0.4, "max", size=(20, 25))


@query("segment_volume_mean")
def segment_volume_mean(spark, sf_dir):
    """Basins merged by the mean affinity; tests check basins and merges against plain loops."""
    return agglomeration.segmented_volume(_levels(spark, sf_dir), {a: "a" for a in "zyx"}, 0.5, "mean", size=(20, 25))


#: Labels with holes: rows of the holes are missing.
_HOLED = ", h as (select z, y, x, case when img > 0.9::double then 0 else gt end as l from voxels)"
_DISTANCE = _HOLED + """, d as (select a.z, a.y, a.x, a.l, min(sqrt(9 * (a.z - b.z) * (a.z - b.z) + (a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))) as d from h a join h b on a.l <> b.l and abs(a.z - b.z) <= 6 where a.l <> 0 group by all)"""


def _labels_with_holes(spark, sf_dir):
    return voxels(spark, sf_dir).where("img <= 0.9").select("z", "y", "x", "gt")


@query("distance_volume", _DISTANCE + " select z, y, x, round(d, 9) as distance from d union all select z, y, x, 0 from h where l = 0")
def distance_volume(spark, sf_dir):
    """Distances to the nearest voxel of another label, whatever blocks lie between (within six slices there always is one here)."""
    return rounded(distances.distance_transform(_labels_with_holes(spark, sf_dir), "gt", (3.0, 1.0, 1.0)))


@query("object_energy", _DISTANCE + ", m as (select l, max(d) as m from d group by l) select z, y, x, round(d / m, 9) as energy from d join m using (l) union all select z, y, x, -1 from h where l = 0")
def object_energy(spark, sf_dir):
    return rounded(distances.object_energy(_labels_with_holes(spark, sf_dir), "gt", (3.0, 1.0, 1.0)))


@query("cleft_distances", """, p as (select z * 3::double as z, y, x, img > 0.98::double as a, img < 0.01::double as b from voxels where img > 0.98::double or img < 0.01::double),
d as (select 0 as side, p.z, p.y, p.x, min(sqrt((p.z - q.z) * (p.z - q.z) + (p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))) as d from p, p q where p.a and q.b group by all
 union all select 1, p.z, p.y, p.x, min(sqrt((p.z - q.z) * (p.z - q.z) + (p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))) from p, p q where p.b and q.a group by all)
select cast(side as integer) as side, round(avg(d), 9) as mean, round(stddev_pop(d), 9) as std, round(max(d), 9) as most, round(quantile_cont(d, 0.5), 9) as median, count(*) as n, count(*) filter (d > 8) as far from d group by side""")
def cleft_distances(spark, sf_dir):
    """How far two sets of voxels are from each other, both ways; no distance is cut off."""
    return rounded(distances.side_distances(voxels(spark, sf_dir), F.col("img") > 0.98, F.col("img") < 0.01, (3.0, 1.0, 1.0), 8.0))


_MINIMA = ", v as (select z, y, x, floor(img * 5) as v, cast(floor(img * 5) + 1 as bigint) as l from voxels)" + _reach("v", "a.z = b.z and abs(a.y - b.y) + abs(a.x - b.x) = 1")
_MINIMA += """, k as (select w.*, component from c join w using (i)), bad as (select distinct a.component from k a join k b on a.z = b.z and abs(a.y - b.y) + abs(a.x - b.x) = 1 and b.v {} a.v)
select z, y, x, component as seed from k anti join bad using (component)"""


@query("slice_minima", _MINIMA.format("<"))
def slice_minima(spark, sf_dir):
    """Regional minima of every slice, as seeds."""
    v = voxels(spark, sf_dir).select("z", "y", "x", F.floor(F.col("img") * 5).alias("v"))
    return seeds.regional_extrema(v, "v", True, ("y", "x"), (20, 25))


@query("slice_maxima", _MINIMA.format(">"))
def slice_maxima(spark, sf_dir):
    v = voxels(spark, sf_dir).select("z", "y", "x", F.floor(F.col("img") * 5).alias("v"))
    return seeds.regional_extrema(v, "v", False, ("y", "x"), (20, 25))


@query("interior_seeds")
def interior_seeds(spark, sf_dir):
    """Peaks of the distance to the border that keep two voxels apart; a test compares them with a plain loop."""
    return seeds.interior_seeds(voxels(spark, sf_dir), "img", 0.4, 2, size=(20, 25))


_SHARES = [0.01, 0.25, 0.5, 0.7, 0.99]


@query("exact_quantiles", "select share, round(q, 9) as value from (select unnest([" + ", ".join(f"{s}::double" for s in _SHARES) + "]) as share, unnest(quantile_cont(img, [" + ", ".join(map(str, _SHARES)) + "])) as q from voxels)")
def exact_quantiles(spark, sf_dir):
    found = quantiles.exact_quantiles(voxels(spark, sf_dir), "img", _SHARES)
    return rounded(spark.createDataFrame(list(zip(_SHARES, found)), "share double, value double"))


@query("percentile_normalised", ", p as (select quantile_cont(img, 0.01) as a, quantile_cont(img, 0.99) as b from voxels) select z, y, x, round((img - a) / (b - a), 9) as img from voxels, p")
def percentile_normalised(spark, sf_dir):
    return rounded(quantiles.normalised(voxels(spark, sf_dir).select("z", "y", "x", "img"), "img"))


@query("slice_supervoxels")
def slice_supervoxels(spark, sf_dir):
    """Slices flooded from the maxima of the distance to boundaries; a test compares them with lowest paths."""
    return supervoxels.slice_supervoxels(voxels(spark, sf_dir), "img", "maxima_distance", size=(20, 25))


@query("supervoxels_merged")
def supervoxels_merged(spark, sf_dir):
    """Supervoxels of slices, merged over the whole volume by the mean affinity: the volume's segmentation from flat pieces."""
    rows = supervoxels.slice_supervoxels(voxels(spark, sf_dir), "img", "minima", size=(20, 25)).join(voxels(spark, sf_dir).select("z", "y", "x", (1 - F.col("img")).alias("aff")), ["z", "y", "x"])
    merges = agglomeration.agglomerated(agglomeration.region_edges(regions.faces(rows, "id", {a: "aff" for a in "zyx"})), 0.3, "mean")
    return labels.renamed(rows, "id", merges)


@query("seeded_watershed")
def seeded_watershed(spark, sf_dir):
    """The whole volume flooded from peaks of its interior; a test compares it with lowest paths."""
    v = voxels(spark, sf_dir).select("z", "y", "x", "img")
    rows = v.join(interior_seeds(spark, sf_dir), ["z", "y", "x"], "left")
    return flooding.seeded_watershed(rows, "img", "seed", (20, 25))
