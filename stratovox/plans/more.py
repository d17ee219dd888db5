"""Queries of tiles, pasting, windows, per-slice matching, intensity changes and clustering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratovox.operators import augment, crops, labels, metrics, stencils
from stratovox.plans.metrics import _FOUND, rounded
from stratovox.plans.regions import _boxed
from stratovox.plans.registry import components_sql, query
from stratovox.sources.volumes import table, voxels


@query("vi_table", """,
c as (select gt, seg, count(*)::double as n from voxels where gt <> 0 group by all),
t as (select gt, seg, n, sum(n) over (partition by gt) as tg, sum(n) over () as total from c)
select gt, round(sum(-n / total * log2(n / tg)), 9) as entropy, round(max(tg) / max(total), 9) as share from t group by gt""")
def vi_table(spark, sf_dir):
    """What each truth label adds to the information split score."""
    counts = metrics.contingency(voxels(spark, sf_dir), "gt", "seg", (0,), ()).withColumn("n", F.col("n").cast("double"))
    total = counts.agg(F.sum("n").alias("total"))
    rows = counts.withColumn("tg", F.sum("n").over(Window.partitionBy("gt"))).join(F.broadcast(total))
    return rounded(rows.groupBy("gt").agg(F.sum(-F.col("n") / F.col("total") * F.log2(F.col("n") / F.col("tg"))).alias("entropy"), (F.max("tg") / F.max("total")).alias("share")))


_SLICES = f""",
c as (select z, gt, {_FOUND} as f, count(*) as n from voxels group by all),
t as (select *, sum(n) over (partition by z, gt) as ta, sum(n) over (partition by z, f) as tb from c),
k as (select unnest([0.6::double, 0.75::double, 0.9::double]) as threshold),
m as (select z, threshold, count(*) filter (gt <> 0 and f <> 0 and n::double / (ta + tb - n)::double >= threshold) as tp, count(distinct gt) filter (gt <> 0) as nt, count(distinct f) filter (f <> 0) as np
      from t, k group by z, threshold)
"""


@query("matching_micro_macro", _SLICES + """
select threshold, cast(sum(tp) as bigint) as tp, cast(sum(np - tp) as bigint) as fp, cast(sum(nt - tp) as bigint) as fn, round(2 * sum(tp)::double / sum(np + nt), 9) as micro_f1, round(avg(case when tp > 0 then 2 * tp::double / (np + nt) else 0 end), 9) as macro_f1
from m group by threshold""")
def matching_micro_macro(spark, sf_dir):
    """Matching slice by slice: counts added up first, and scores averaged over slices."""
    v = voxels(spark, sf_dir).withColumn("f", F.when(F.col("img") < 0.05, 0).otherwise(F.col("gt")))
    counts = v.groupBy("z", "gt", "f").agg(F.count("*").alias("n"))
    total = lambda c: F.sum("n").over(Window.partitionBy("z", c))
    rows = counts.withColumn("iou", F.col("n") / (total("gt") + total("f") - F.col("n"))).withColumn("threshold", F.explode(F.array(*map(F.lit, (0.6, 0.75, 0.9)))))
    both = (F.col("gt") != 0) & (F.col("f") != 0)
    each = rows.groupBy("z", "threshold").agg(
        F.count(F.when(both & (F.col("iou") >= F.col("threshold")), 1)).alias("tp"), F.count_distinct(F.when(F.col("gt") != 0, F.col("gt"))).alias("nt"), F.count_distinct(F.when(F.col("f") != 0, F.col("f"))).alias("np")
    )
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("np") + F.col("nt"))).otherwise(F.lit(0.0))
    return rounded(each.groupBy("threshold").agg(
        F.sum("tp").alias("tp"), F.sum(F.col("np") - F.col("tp")).alias("fp"), F.sum(F.col("nt") - F.col("tp")).alias("fn"),
        (2 * F.sum("tp") / F.sum(F.col("np") + F.col("nt"))).alias("micro_f1"), F.avg(f1).alias("macro_f1"),
    ))


@query("mask_apply_channels", """, k as (select unnest(range(0, 4)) as c)
select cast(c as integer) as c, z, y, x, round(case when c < 3 then img * (c + 1) * msk::integer else img * (c + 1) end, 9) as v from voxels, k""")
def mask_apply_channels(spark, sf_dir):
    """A mask of one channel over the first three of four; the fourth stays."""
    rows = voxels(spark, sf_dir).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(3))))
    value = F.col("img") * (F.col("c") + 1)
    return rounded(rows.select("c", "z", "y", "x", F.when(F.col("c") < 3, value * F.col("msk").cast("int")).otherwise(value).alias("v")))


@query("tile_to_volume", """, t as (select distinct z, y // 10 as r, x // 10 as c from voxels where (z + y // 10 + x // 10) % 3 <> 0)
select v.z, v.y, v.x, cast(case when t.z is null then 128 else floor(img * 255) end as integer) as v from voxels v left join t on t.z = v.z and t.r = v.y // 10 and t.c = v.x // 10 where v.y >= 3 and v.y < 17 and v.x >= 5 and v.x < 22""")
def tile_to_volume(spark, sf_dir):
    """A box read from the tiles that it touches; what a missing tile would hold is background 128."""
    v = voxels(spark, sf_dir).select("z", "y", "x", F.floor(F.col("img") * 255).alias("v"))
    tiles = v.select("z", F.expr("cast(y div 10 as int)").alias("r"), F.expr("cast(x div 10 as int)").alias("c")).distinct().where("(z + r + c) % 3 <> 0")
    depth = v.agg(F.max("z") + 1).first()[0]
    return augment.read_tiles(v, "v", tiles, (10, 10), (0, 3, 5), (depth, 17, 22))


@query("paste_patch", """, p as (select z, cast(y + 4 as integer) as y, cast(x + 6 as integer) as x, seg from voxels where y < 8 and x < 8)
select v.z, v.y, v.x, case when coalesce(p.seg, 0) <> 0 then p.seg else v.seg end as seg from voxels v left join p on p.z = v.z and p.y = v.y and p.x = v.x""")
def paste_patch(spark, sf_dir):
    """A patch put over a volume; its background doesn't cover."""
    v = voxels(spark, sf_dir).select("z", "y", "x", "seg")
    return crops.pasted(v, v.where("y < 8 and x < 8"), "seg", (0, 4, 6))


@query("foreground_windows", """select z // 2 as wz, y // 5 as wy, x // 5 as wx, count(*) filter (msk) as n, count(distinct seg) filter (msk) as kinds from voxels group by all
having count(*) filter (msk) >= 0.8 * count(*) and count(distinct seg) filter (msk) >= 25""")
def foreground_windows(spark, sf_dir):
    """Windows with enough foreground and enough different labels."""
    place = [F.expr(f"cast({a} div {w} as int)").alias(f"w{a}") for a, w in (("z", 2), ("y", 5), ("x", 5))]
    grouped = voxels(spark, sf_dir).groupBy(*place).agg(F.count("*").alias("all"), F.count(F.when(F.col("msk"), 1)).alias("n"), F.count_distinct(F.when(F.col("msk"), F.col("seg"))).alias("kinds"))
    return grouped.where((F.col("n") >= 0.8 * F.col("all")) & (F.col("kinds") >= 25)).drop("all")


@query("relaxed_bboxes", """select seg, greatest(min(z) - 2, 0) as z_min, least(max(z) + 2, (select max(z) + 1 from voxels)) as z_max, greatest(min(y) - 2, 0) as y_min, least(max(y) + 2, 20) as y_max,
greatest(min(x) - 2, 0) as x_min, least(max(x) + 2, 25) as x_max from voxels where seg <> 0 group by seg having count(*) >= 60""")
def relaxed_bboxes(spark, sf_dir):
    """Boxes of large enough labels, two voxels wider, inside 0 and the volume's size."""
    v = voxels(spark, sf_dir)
    large = labels.size_filtered(v, "seg", smallest=60)
    sizes = v.agg(*((F.max(a) + 1).alias(f"n{a}") for a in "zyx"))
    return labels.boxes(large, "seg").join(F.broadcast(sizes)).select("seg", *(c for a in "zyx" for c in (F.greatest(F.col(f"{a}_min") - 2, F.lit(0)).alias(f"{a}_min"), F.least(F.col(f"{a}_max") + 2, F.col(f"n{a}")).alias(f"{a}_max"))))


@query("intensity_augment", "select z, y, x, round(pow(least(greatest((img - 0.5::double) * 1.2::double + 0.55::double, 0), 1), 0.9::double), 9) as img from voxels")
def intensity_augment(spark, sf_dir):
    """Contrast, brightness and gamma with fixed parameters."""
    return rounded(voxels(spark, sf_dir).select("z", "y", "x", augment.intensity(F.col("img"), 1.2, 0.05, 0.9).alias("img")))


@query("missing_sections", """, k as (select z, row_number() over (order by z) - 1 as nz from (select distinct z from voxels where z % 5 <> 3))
select cast(nz as integer) as z, y, x, round(img, 9) as img from voxels join k using (z)""")
def missing_sections(spark, sf_dir):
    """Every fifth slice is lost and the others close up."""
    return rounded(augment.without_slices(voxels(spark, sf_dir).select("z", "y", "x", "img"), F.col("z") % 5 == 3))


@query("slice_mean_fill", "select z, y, x, round(case when x - y between -1 and 1 then avg(img) over (partition by z) else img end, 9) as img from voxels")
def slice_mean_fill(spark, sf_dir):
    """A band of each slice takes the slice's mean."""
    return rounded(augment.filled_with_mean(voxels(spark, sf_dir), "img", (F.col("x") - F.col("y")).between(-1, 1)))


@query("displaced_slices", """, n as (select z, cast(y + 2 as integer) as y, cast(x - 3 as integer) as x, seg from voxels where z >= 1 union all select z, y, x, seg from voxels where z < 1)
select v.z, v.y, v.x, coalesce(n.seg, 0) as seg from voxels v left join n using (z, y, x)""")
def displaced_slices(spark, sf_dir):
    """From the second slice on everything lies two rows lower and three columns to the left."""
    return augment.displaced_below(voxels(spark, sf_dir), "seg", 1, (2, -3))


@query("blurred_slices", """, a as (select z, y, x, img, avg(img) over (partition by z, y order by x rows between 1 preceding and 1 following) as m from voxels),
b as (select z, y, x, img, avg(m) over (partition by z, x order by y rows between 1 preceding and 1 following) as m from a) select z, y, x, round(case when z % 2 = 1 then m else img end, 9) as img from b""")
def blurred_slices(spark, sf_dir):
    return rounded(augment.blurred_slices(voxels(spark, sf_dir), "img", F.col("z") % 2 == 1))


@query("cut_out_boxes", "select z, y, x, case when (z < 2 and y between 2 and 6 and x between 3 and 9) or (y >= 15 and x >= 20) then 0 else img end as img from voxels")
def cut_out_boxes(spark, sf_dir):
    boxes = [((0, 2, 3), (2, 7, 10)), ((0, 15, 20), (1 << 30, 20, 25))]
    return augment.combined(voxels(spark, sf_dir), lambda v: augment.cut_out(v, "img", boxes))


@query("chunk_bounds", """, s as (select max(z) + 1 as nz, 20 as ny, 25 as nx from voxels), c as (select unnest(range(0, 2 * 3 * 4)) as k)
select cast(k as integer) as chunk, cast(floor((k // 12) / 3 * nz) as integer) as z1, cast(floor((k // 12 + 2) / 3 * nz) as integer) as z2, cast(floor((k // 4 % 3) / 4 * ny) as integer) as y1,
cast(floor((k // 4 % 3 + 2) / 4 * ny) as integer) as y2, cast(floor((k % 4) / 5 * nx) as integer) as x1, cast(floor((k % 4 + 2) / 5 * nx) as integer) as x2 from c, s""")
def chunk_bounds(spark, sf_dir):
    """A tile data set's chunks that overlap by half."""
    return augment.chunk_bounds(voxels(spark, sf_dir), (2, 3, 4), 2)


@query("chunk_shards", """, c as (select distinct seg from voxels), n as (select *, row_number() over (order by seg) - 1 as i, count(*) over () as n from c)
select seg, cast(least(i // (n // 4), 3) as integer) as shard from n""")
def chunk_shards(spark, sf_dir):
    """Four contiguous shards of the ordered ids; the last one takes the remainder."""
    from stratovox.operators.grid import running_before

    ids = voxels(spark, sf_dir).select("seg").distinct().withColumn("one", F.lit(1))
    total = ids.agg(F.expr("greatest(count(*) div 4, 1)").alias("size"))
    ranked = running_before(ids, "seg", "one", "i").join(F.broadcast(total))
    return ranked.select("seg", F.least(F.expr("i div size"), F.lit(3)).cast("int").alias("shard"))


_EDGES = ", ed as (select z, y, x, img, cast(" + " or ".join(f"coalesce(lag(gt) over ({w}), gt) <> coalesce(lead(gt) over ({w}), gt)" for w in ("partition by z, x order by y", "partition by z, y order by x")) + " as integer) as v from voxels)"
_CONTOUR, _CONTOURED = _boxed("max", "v", "ed", (0, 1, 1))
_GROWN, _GROWN_LAST = _boxed("max", "c", "co", (0, 1, 1))
_BC = _EDGES + _CONTOUR + f""", a as (select z, y, x, z * 500 + y * 25 + x + 1 as i, 1 as l, ed.img > 0.1::double and t.v = 0 as fg from ed join {_CONTOURED} t using (z, y, x)),
w as (select * from a where fg)""" + components_sql("w", "ne") + ", co as (select z, y, x, coalesce(low, 0) as c from a left join reach using (i))" + _GROWN


@query("bc_connected", _BC + f", s as (select c from {_GROWN_LAST} where c <> 0 group by c having count(*) >= 5) select z, y, x, coalesce(s.c, 0) as label from {_GROWN_LAST} left join s using (c)")
def bc_connected(spark, sf_dir):
    """Objects of foreground without contour, connected by faces, grown by one voxel in the slice, and of five voxels at least."""
    v = voxels(spark, sf_dir)
    edge = stencils.boundaries(v, "gt", 1, filled=True)
    inner = v.join(edge, ["z", "y", "x"]).select("z", "y", "x", ((F.col("img") > 0.1) & (F.col("boundary") == 0)).cast("long").alias("l"))
    grown = stencils.box(labels.grid_components(inner, "l"), "component", (0, 1, 1), "max", "label").select("z", "y", "x", "label")
    return labels.size_filtered(grown, "label", smallest=5)


@query("kmeans_suggestion")
def kmeans_suggestion(spark, sf_dir):
    """The vector nearest to the centre of each of ten clusters (rows only: the clusters depend on the engine)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    data = rows.select("vec_id", "v", array_to_vector("v").alias("features"))
    model = KMeans(k=10, seed=7, maxIter=10).fit(data)
    centres = F.array(*(F.array(*(F.lit(float(x)) for x in c)) for c in model.clusterCenters()))
    found = model.transform(data).select("vec_id", "v", "prediction", F.element_at(centres, F.col("prediction") + 1).alias("c"))
    distance = F.aggregate(F.zip_with("v", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    best = found.groupBy("prediction").agg(F.min(F.struct(distance.alias("d"), "vec_id")).alias("b"), F.count("*").alias("n"))
    return best.select(F.col("prediction").alias("cluster"), F.col("b.vec_id").alias("vec_id"), "n")
