"""Queries of streams, block bookkeeping, block kernels and vector selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import grid, kernels, overlap, selection
from stratovox.operators.stencils import before
from stratovox.plans import overlap as merge
from stratovox.plans.metrics import rounded
from stratovox.plans.registry import query
from stratovox.plans.scratch import scratch
from stratovox.sources.volumes import table, voxels
from stratovox.streaming import incremental, numbering


@query("incremental_contingency", "select seg, gt, count(*) as n from voxels where seg <> 0 and gt <> 0 group by all")
def incremental_contingency(spark, sf_dir):
    """Pair counts of blocks that arrive file by file: equal to one aggregation over all."""
    rows = voxels(spark, sf_dir).select("z", "seg", "gt")
    path = scratch(spark, "blocks")
    rows.write.parquet(path)
    stream = incremental.block_stream(spark, path, rows.schema, 64).where("seg <> 0 and gt <> 0")
    return incremental.stream_result(incremental.counted_stream(stream, "seg", "gt"), "counts")


@query("metadata_upsert", merge._LOCAL + """, n as (select idx, max_id + 1000 as max_id, true as done from mx where idx % 3 = 0)
select idx, max_id, false as done from mx where idx not in (select idx from n) union all select * from n""")
def metadata_upsert(spark, sf_dir):
    old = overlap.block_sizes(merge._labelled(spark, sf_dir)).withColumn("done", F.lit(False))
    new = old.where("idx % 3 = 0").select("idx", (F.col("max_id") + 1000).alias("max_id"), F.lit(True).alias("done"))
    return incremental.upserted(old, new, "idx")


@query("resumable_merge_state", merge._BLOCKS + "select idx from blocks where idx % 4 <> 0")
def resumable_merge_state(spark, sf_dir):
    blocks = merge.block_grid(spark, sf_dir)
    return incremental.pending(blocks, blocks.where("idx % 4 = 0"), "idx").select("idx")


@query("resumed_offsets", merge._LOCAL + """, n as (select coalesce(sum(max_id), 0) + 1 as g from mx where idx % 4 = 0)
select idx, cast(g + coalesce(sum(max_id) over (order by idx rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from mx, n where idx % 4 <> 0""")
def resumed_offsets(spark, sf_dir):
    """Every fourth block was merged before; the ids of the others go on from there."""
    sizes = overlap.block_sizes(merge._labelled(spark, sf_dir))
    return incremental.resumed_offsets(sizes, sizes.where("idx % 4 = 0"))


@query("streamed_block_offsets", merge._LOCAL + """ select 'v' as volume, idx, cast(coalesce(sum(max_id) over (order by idx rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset", max_id from mx""")
def streamed_block_offsets(spark, sf_dir):
    """Offsets of blocks that arrive in two runs of one stream, the first ones twice: as if all had been numbered at once."""
    sizes = overlap.block_sizes(merge._labelled(spark, sf_dir)).select(F.lit("v").alias("volume"), "idx", "max_id")
    source, out = scratch(spark, "arriving"), scratch(spark, "offsets")
    middle = sizes.agg(F.expr("max(idx) div 2").alias("m")).first()["m"]
    for part in (sizes.where(F.col("idx") <= middle), sizes):
        part.write.mode("append").parquet(source)
        numbering.run_numbering(spark.readStream.schema(sizes.schema).parquet(source), out, f"{out}-state")
    return spark.read.parquet(out)


@query("agglomerate_kernel")
def agglomerate_kernel(spark, sf_dir):
    """Merge history of mean-affinity agglomeration in every block; a test checks it against a plain loop."""
    rows = grid.in_blocks(voxels(spark, sf_dir).select("z", "y", "x", "seg", "img"), (8, 8, 8), (0, 0, 0))
    near = [F.struct(before("seg", axis, 1, "idx").alias("o"), F.col("img").alias("aff")) for axis in "zyx"]
    faces = rows.withColumn("n_", F.array(*near)).select("idx", "seg", F.explode("n_").alias("n")).where("seg <> 0 and n.o <> 0 and seg <> n.o")
    edges = faces.groupBy(F.col("idx").alias("block"), F.least("seg", "n.o").alias("u"), F.greatest("seg", "n.o").alias("v")).agg(F.sum("n.aff").alias("total"), F.count("*").alias("n"))
    return kernels.agglomerated(edges, 0.6)


@query("watershed_blocks")
def watershed_blocks(spark, sf_dir):
    """Every voxel of every block belongs to the seed that reaches it over the lowest path."""
    rows = grid.in_blocks(voxels(spark, sf_dir).select("z", "y", "x", "img"), (8, 8, 8), (0, 0, 0)).withColumnRenamed("idx", "block")
    return kernels.watershed_blocks(rows, "img")


@query("block_distances", merge._BLOCKS.replace("unnest(range(0, nz, 6))", "unnest(range(0, nz, 8))").replace("unnest(range(0, ny, 6))", "unnest(range(0, ny, 8))").replace("unnest(range(0, nx, 6))", "unnest(range(0, nx, 8))") + """,
b as (select idx, z, y, x, msk from voxels join blocks on z >= z1 and z < z2 and y >= y1 and y < y2 and x >= x1 and x < x2),
d as (select a.idx, a.z, a.y, a.x, a.msk, min(case when not b.msk then sqrt(9 * (a.z - b.z) * (a.z - b.z) + (a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x)) end) as d from b a join b on a.idx = b.idx group by all)
select idx as block, z, y, x, round(case when not msk then 0 else coalesce(d, -1) end::double, 9) as distance from d""")
def block_distances(spark, sf_dir):
    rows = grid.in_blocks(voxels(spark, sf_dir).select("z", "y", "x", F.col("msk").cast("int").alias("m")), (8, 8, 8), (0, 0, 0)).withColumnRenamed("idx", "block")
    return rounded(kernels.distance_blocks(rows, "m", (3.0, 1.0, 1.0)))


@query("one_to_one_pairs")
def one_to_one_pairs(spark, sf_dir):
    """Greedy matching of each overlap's pairs, most common voxels first."""
    return kernels.one_to_one(merge.select_union_pairs(spark, sf_dir), [F.desc("n"), "a", "b"])


@query("far_tail_selection", """with s as (select vec_id, embedding from embeddings where vec_id % 50 = 0),
d as (select e.vec_id, min(list_sum(list_transform(list_zip(e.embedding, s.embedding), lambda p: (p[1]::double - p[2]::double) * (p[1]::double - p[2]::double)))) as d from embeddings e, s where e.vec_id % 50 <> 0 group by e.vec_id),
r as (select vec_id, d, row_number() over (order by round(d, 6) desc, vec_id) as r from d)
select vec_id, round(d, 6) as distance from r where r <= (select count(*) // 5 from d)""", voxels=False)
def far_tail_selection(spark, sf_dir):
    """The fifth of all vectors that is farthest from the selected ones (ids divisible by 50, compared in blocks)."""
    rows = table(spark, sf_dir, "embeddings").where("embedding is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    found = selection.nearest_distances(rows.where("vec_id % 50 <> 0"), rows.where("vec_id % 50 = 0"), "vec_id", "v")
    return selection.farthest(found.select("vec_id", F.round("d", 6).alias("distance")), "vec_id", "distance", 5)
