"""Queries of labels, objects, volumes, tables of blocks and vectors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratovox.operators import labels, volumes
from stratovox.operators.grid import running_before
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import components_sql, query
from stratovox.sources.volumes import colour_ids, grid_of_name, one_channel, region, table, voxels


@query("instance_sizes", "select seg, count(*) as size from voxels where seg <> 0 group by seg")
def instance_sizes(spark, sf_dir):
    return labels.sizes(voxels(spark, sf_dir), "seg")


@query("instance_centroids", "select seg, round(avg(z) * 30, 9) as cz, round(avg(y) * 6, 9) as cy, round(avg(x) * 6, 9) as cx from voxels where seg <> 0 group by seg")
def instance_centroids(spark, sf_dir):
    return rounded(labels.centroids(voxels(spark, sf_dir), "seg", (30, 6, 6)))


@query("instance_bboxes", "select seg, min(z) as z_min, max(z) as z_max, min(y) as y_min, max(y) as y_max, min(x) as x_min, max(x) as x_max from voxels where seg <> 0 group by seg")
def instance_bboxes(spark, sf_dir):
    return labels.boxes(voxels(spark, sf_dir), "seg")


@query("nn_distance", """, c as (select seg, avg(z) * 30 as cz, avg(y) * 6 as cy, avg(x) * 6 as cx from voxels where seg <> 0 group by seg)
select a.seg, round(min(sqrt((a.cz - b.cz) * (a.cz - b.cz) + (a.cy - b.cy) * (a.cy - b.cy) + (a.cx - b.cx) * (a.cx - b.cx))), 6) as distance from c a join c b on a.seg <> b.seg group by a.seg""")
def nn_distance(spark, sf_dir):
    return rounded(labels.nearest_other(labels.centroids(voxels(spark, sf_dir), "seg", (30, 6, 6)), "seg", 8.0), 6)


@query("intensity_by_fg", "select seg <> 0 as foreground, count(*) as n, round(avg(img), 9) as mean from voxels group by all")
def intensity_by_fg(spark, sf_dir):
    return rounded(voxels(spark, sf_dir).groupBy((F.col("seg") != 0).alias("foreground")).agg(F.count("*").alias("n"), F.avg("img").alias("mean")))


@query("class_balance_weight", """, r as (select least(greatest(avg(msk::integer), 0.05), 0.95) as w from voxels)
select round(w, 9) as ratio, round(greatest(w, 1 - w) / least(w, 1 - w), 9) as factor, w < 0.5 as minority_foreground from r""")
def class_balance_weight(spark, sf_dir):
    share = voxels(spark, sf_dir).agg(F.least(F.greatest(F.avg(F.col("msk").cast("int")), F.lit(0.05)), F.lit(0.95)).alias("w"))
    w, rest = F.col("w"), 1 - F.col("w")
    return rounded(share.select(w.alias("ratio"), (F.greatest(w, rest) / F.least(w, rest)).alias("factor"), (w < 0.5).alias("minority_foreground")))


@query("relabel_compact", ", r as (select seg, row_number() over (order by seg) as k from (select distinct seg from voxels where seg <> 0)) select z, y, x, coalesce(k, 0) as seg from voxels left join r using (seg)")
def relabel_compact(spark, sf_dir):
    return labels.compacted(voxels(spark, sf_dir), "seg")


@query("remove_small", "select z, y, x, case when count(*) over (partition by seg) < 70 then 0 else seg end as seg from voxels")
def remove_small(spark, sf_dir):
    return labels.size_filtered(voxels(spark, sf_dir), "seg", smallest=70)


@query("remove_small_2d", "select z, y, x, case when count(*) over (partition by seg, z) < 4 then 0 else seg end as seg from voxels")
def remove_small_2d(spark, sf_dir):
    return labels.size_filtered(voxels(spark, sf_dir), "seg", smallest=4, by=("z",))


@query("remove_large", "select z, y, x, case when count(*) over (partition by seg) > 70 then 0 else seg end as seg from voxels")
def remove_large(spark, sf_dir):
    return labels.size_filtered(voxels(spark, sf_dir), "seg", largest=70)


@query("grid_connected_components", ", a as (select z, y, x, z * 500 + y * 25 + x + 1 as i, case when msk then 1 + seg % 2 else 0 end as l from voxels), w as (select * from a where l <> 0)" + components_sql("w")
       + " select z, y, x, coalesce(low, 0) as component from a left join reach using (i)")
def grid_connected_components(spark, sf_dir):
    """Face-connected components of two classes inside the mask; a test compares them with a flood fill."""
    v = voxels(spark, sf_dir).select("z", "y", "x", F.when(F.col("msk"), 1 + F.col("seg") % 2).otherwise(F.lit(0)).alias("l"))
    return labels.grid_components(v, "l")


@query("binary_connected", ", a as (select z, y, x, z * 500 + y * 25 + x + 1 as i, 1 as l, img > 0.4::double as fg from voxels), w as (select * from a where fg)" + components_sql("w")
       + ", k as (select low from reach group by low having count(*) >= 10) select z, y, x, coalesce(k.low, 0) as component from a left join reach using (i) left join k on k.low = reach.low")
def binary_connected(spark, sf_dir):
    """Foreground above a threshold, its face-connected components, and those of at least ten voxels."""
    v = voxels(spark, sf_dir).select("z", "y", "x", (F.col("img") > 0.4).cast("long").alias("l"))
    return labels.size_filtered(labels.grid_components(v, "l"), "component", smallest=10)


@query("stitch_slices_iou", """, p as (select a.z, a.gt * 10 + a.seg % 3 as old, b.gt * 10 + b.seg % 3 as new from voxels a join voxels b on b.z = a.z + 1 and b.y = a.y and b.x = a.x),
c as (select z, old, new, count(*) as n from p group by all), t as (select *, sum(n) over (partition by z, old) as ta, sum(n) over (partition by z, new) as tb from c),
i as (select z, old, new, n::double / (ta + tb - n)::double as iou from t where n::double / (ta + tb - n)::double >= 0.15),
f as (select *, row_number() over (partition by z, old order by iou desc, new) as r from i), s as (select *, row_number() over (partition by z, new order by iou desc, old) as q from f where r = 1)
select z, old, new, round(iou, 9) as iou from s where q = 1""")
def stitch_slices_iou(spark, sf_dir):
    v = voxels(spark, sf_dir).select("z", "y", "x", (F.col("gt") * 10 + F.col("seg") % 3).alias("l"))
    return rounded(labels.stitched(v, "l", 0.15))


@query("polarity_targets", "select z, y, x, cast(case when seg = 0 then 0 when seg % 2 = 1 then 1 else 2 end as integer) as polarity from voxels")
def polarity_targets(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", F.when(F.col("seg") == 0, 0).when(F.col("seg") % 2 == 1, 1).otherwise(2).alias("polarity"))


@query("remove_masks", "select z, y, x, case when seg in (3, 5, 7) then 0 else seg end as seg from voxels")
def remove_masks(spark, sf_dir):
    return labels.filtered(voxels(spark, sf_dir), "seg", ~F.col("seg").isin(3, 5, 7))


@query("merge_masks", "select z, y, x, case when seg in (4, 6) then 3 when seg in (9) then 8 else seg end as seg from voxels")
def merge_masks(spark, sf_dir):
    lists = spark.createDataFrame([([3, 4, 6],), ([8, 9],)], "ids array<long>")
    table_ = lists.select(F.explode("ids").alias("id"), F.element_at("ids", 1).alias("rep"))
    return labels.renamed(voxels(spark, sf_dir), "seg", table_)


@query("add_masks", ", m as (select max(gt) as m from voxels) select z, y, x, case seg when 3 then m + 1 when 5 then m + 2 else gt end as gt from voxels, m")
def add_masks(spark, sf_dir):
    v = voxels(spark, sf_dir)
    top = v.agg(F.max("gt").alias("m"))
    listed = F.array_position(F.array(F.lit(3), F.lit(5)).cast("array<bigint>"), F.col("seg"))
    return v.join(F.broadcast(top)).select("z", "y", "x", F.when(listed > 0, F.col("m") + listed).otherwise(F.col("gt")).alias("gt"))


@query("roi_crop", "select z, y, x, seg from voxels where z >= 1 and z < 15 and y >= 3 and y < 17 and x >= 5 and x < 20")
def roi_crop(spark, sf_dir):
    return region(voxels(spark, sf_dir), (1, 3, 5), (15, 17, 20)).select("z", "y", "x", "seg")


@query("mask_apply", "select z, y, x, img * msk::integer as img from voxels")
def mask_apply(spark, sf_dir):
    v = voxels(spark, sf_dir)
    return volumes.masked(v, v.select("z", "y", "x", F.col("msk").cast("int").alias("m")), "img", "m")


@query("trim_zeros", """, v as (select z, y, x, case when z between 1 and 12 and y between 4 and 15 then seg else 0 end as seg from voxels),
b as (select min(z) z1, max(z) z2, min(y) y1, max(y) y2, min(x) x1, max(x) x2 from v where seg <> 0)
select z - z1 as z, y - y1 as y, x - x1 as x, seg from v, b where z between z1 and z2 and y between y1 and y2 and x between x1 and x2""")
def trim_zeros(spark, sf_dir):
    v = voxels(spark, sf_dir).select("z", "y", "x", F.when(F.col("z").between(1, 12) & F.col("y").between(4, 15), F.col("seg")).otherwise(F.lit(0)).alias("seg"))
    return volumes.trimmed(v, "seg")


@query("downsample_mean", "select z // 2 as z, y // 2 as y, x // 2 as x, round(avg(img), 9) as img from voxels group by all")
def downsample_mean(spark, sf_dir):
    return rounded(volumes.downsampled_mean(voxels(spark, sf_dir), "img", (2, 2, 2)))


@query("downsample_mode", """, c as (select z // 2 as z, y // 2 as y, x // 2 as x, seg % 5 as s, count(*) as n from voxels group by all), r as (select *, row_number() over (partition by z, y, x order by n desc, s) as r from c)
select z, y, x, s from r where r = 1""")
def downsample_mode(spark, sf_dir):
    return volumes.downsampled_mode(voxels(spark, sf_dir).select("z", "y", "x", F.expr("seg % 5").alias("s")), "s", (2, 2, 2))


@query("resize_nearest", """, n as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels), m as (select *, 2 * nz as mz, 10 as my, 38 as mx from n),
t as (select tz.t as z, ty.t as y, tx.t as x, (tz.t * nz) // mz as oz, (ty.t * ny) // my as oy, (tx.t * nx) // mx as ox from m, lateral (select unnest(range(0, mz)) as t) tz, lateral (select unnest(range(0, my)) as t) ty, lateral (select unnest(range(0, mx)) as t) tx)
select cast(t.z as integer) as z, cast(t.y as integer) as y, cast(t.x as integer) as x, seg from t join voxels v on v.z = oz and v.y = oy and v.x = ox""")
def resize_nearest(spark, sf_dir):
    return volumes.resized_nearest(voxels(spark, sf_dir), "seg", (2.0, 0.5, 1.5))


@query("flip_transpose", "select cast(19 - z as integer) as z, x as y, cast(19 - y as integer) as x, seg from (select * replace (z + 19 - (select max(z) from voxels) as z) from voxels)")
def flip_transpose(spark, sf_dir):
    return volumes.flipped(voxels(spark, sf_dir).select("z", "y", "x", "seg"), ("z", "y"), transpose=True)


@query("reflect_pad", """, s as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels),
tz as (select unnest(range(-1, nz + 1)) as t, nz as n from s), ty as (select unnest(range(-2, ny + 2)) as t, ny as n from s), tx as (select unnest(range(-3, nx + 3)) as t, nx as n from s)
select cast(tz.t + 1 as integer) as z, cast(ty.t + 2 as integer) as y, cast(tx.t + 3 as integer) as x, seg from tz, ty, tx, voxels v
where v.z = case when tz.t < 0 then -tz.t when tz.t >= tz.n then 2 * (tz.n - 1) - tz.t else tz.t end and v.y = case when ty.t < 0 then -ty.t when ty.t >= ty.n then 2 * (ty.n - 1) - ty.t else ty.t end
  and v.x = case when tx.t < 0 then -tx.t when tx.t >= tx.n then 2 * (tx.n - 1) - tx.t else tx.t end""")
def reflect_pad(spark, sf_dir):
    return volumes.reflect_padded(voxels(spark, sf_dir).select("z", "y", "x", "seg"), (1, 2, 3))


@query("normalize_range", ", b as (select min(img) as lo, max(img) as hi from voxels) select z, y, x, cast(floor((img - lo) / (hi - lo) * 255 + 1e-9) as integer) as img from voxels, b")
def normalize_range(spark, sf_dir):
    return volumes.normalised_range(voxels(spark, sf_dir), "img")


@query("vast_rgb_to_id", "select z, y, x, cast((seg % 3) * 65536 + (seg % 7) * 256 + seg % 11 as bigint) as id from voxels")
def vast_rgb_to_id(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", colour_ids(F.col("seg") % 3, F.col("seg") % 7, F.col("seg") % 11).alias("id"))


@query("last_writer_wins", """select l_orderkey, strftime(l_shipdate, '%Y-%m-%d') as l_shipdate, l_quantity from (select *, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_extendedprice desc, l_quantity desc) as r
from lineitem) where r = 1""", voxels=False)
def last_writer_wins(spark, sf_dir):
    """Of rows with one key, the one of the greatest date, line number and price: the value that is written last."""
    rows = table(spark, sf_dir, "lineitem")
    order = F.struct("l_shipdate", "l_linenumber", "l_extendedprice", "l_quantity")
    return rows.groupBy("l_orderkey").agg(F.max(order).alias("o")).select("l_orderkey", F.date_format("o.l_shipdate", "yyyy-MM-dd").alias("l_shipdate"), F.col("o.l_quantity").alias("l_quantity"))


@query("pending_blocks", "select distinct o_orderkey as idx from orders where o_orderkey not in (select l_orderkey from lineitem)", voxels=False)
def pending_blocks(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("idx"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx")).distinct().join(done, "idx", "left_anti")


@query("unmatched_ids", "select distinct seg from voxels where seg <> 0 except select seg from voxels where z < 1")
def unmatched_ids(spark, sf_dir):
    v = voxels(spark, sf_dir)
    return v.where("seg <> 0").select("seg").distinct().join(v.where("z < 1").select("seg"), "seg", "left_anti")


@query("topk_pairs", """, c as (select gt, seg, count(*) as n from voxels where gt <> 0 and seg <> 0 group by all), r as (select *, row_number() over (partition by gt order by n desc, seg) as r from c)
select gt, seg, n, cast(r as integer) as r from r where r <= 2""")
def topk_pairs(spark, sf_dir):
    counts = voxels(spark, sf_dir).where("gt <> 0 and seg <> 0").groupBy("gt", "seg").agg(F.count("*").alias("n"))
    return counts.withColumn("r", F.row_number().over(Window.partitionBy("gt").orderBy(F.desc("n"), "seg"))).where("r <= 2")


@query("manifest_groups", """, i as (select *, (row_number() over (order by seg) - 1) // 16 as part from (select distinct seg from voxels))
select part, string_agg(cast(seg as varchar), ',' order by seg) as ids from i group by all""")
def manifest_groups(spark, sf_dir):
    """Sixteen ids of the ordered list to each part."""
    ids = running_before(voxels(spark, sf_dir).select("seg").distinct().withColumn("one", F.lit(1)), "seg", "one", "place")
    return ids.groupBy(F.expr("place div 16").alias("part")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("seg")), lambda v: v.cast("string")), ",").alias("ids"))


@query("chunk_name_parse", "select distinct z // 8 as cz, y // 8 as cy, x // 8 as cx from voxels")
def chunk_name_parse(spark, sf_dir):
    cells = voxels(spark, sf_dir).select(F.expr("z div 8").alias("a"), F.expr("y div 8").alias("b"), F.expr("x div 8").alias("c")).distinct()
    name = F.format_string("chunk_z%02d_y%02d_x%02d.h5", "a", "b", "c")
    return cells.select(name.alias("name")).select(*grid_of_name(F.col("name")))


@query("channel_mean", """, k as (select unnest(range(0, 3)) as c), v as (select z, y, x, cast(floor(img * 255) as integer) + c * 3 as v from voxels, k)
select z, y, x, cast(trunc(avg(v)) as integer) as v from v group by all""")
def channel_mean(spark, sf_dir):
    """Channels of a volume averaged into one of the same type."""
    rows = voxels(spark, sf_dir).withColumn("c", F.explode(F.array(*map(F.lit, range(3)))))
    return one_channel(rows.select("c", "z", "y", "x", (F.floor(F.col("img") * 255).cast("int") + F.col("c") * 3).alias("v")), "v")


@query("softmax_rows", """select vec_id, k, round(exp(v) / sum(exp(v)) over (partition by vec_id), 9) as softmax
from (select vec_id, unnest(range(0, len(embedding))) as k, unnest(embedding)::double as v from embeddings)""", voxels=False)
def softmax_rows(spark, sf_dir):
    powers = F.transform("embedding", lambda v: F.exp(v.cast("double")))
    total = F.aggregate("p", F.lit(0.0), lambda s, v: s + v)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", powers.alias("p")).select("vec_id", total.alias("t"), F.posexplode("p").alias("k", "e"))
    return rows.select("vec_id", F.col("k").cast("long").alias("k"), F.round(F.col("e") / F.col("t"), 9).alias("softmax"))


@query("region_mask", """, c as (select z, y, x, count(*) over (partition by seg) as n from voxels), m as (select z, y, x, cast(n > 60 and n < 75 as integer) as v from c)
select z, y, x, v as mask from m""")
def region_mask(spark, sf_dir):
    """Labels (0 too) of more than 60 and fewer than 75 voxels; background is a label here."""
    return labels.size_mask(voxels(spark, sf_dir), "seg", 60, 75)
