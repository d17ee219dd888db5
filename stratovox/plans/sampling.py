"""Queries of seeded samples and of chunked stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import grid, labels, sampling
from stratovox.plans import overlap as merge
from stratovox.plans.registry import query
from stratovox.plans.scratch import scratch
from stratovox.sources import chunks
from stratovox.sources.volumes import voxels


def _uniform(text):
    return f"(('0x' || substr(md5({text}), 1, 13))::bigint::double / 4503599627370496::double)"


_DRAWS = f""", n as (select max(z) + 1 as nz from voxels), v as (select 'a' as volume, nz // 1 - 1 as cz, 8 as cy, 10 as cx from n union all select 'b', nz // 2, 3, 2 from n),
k as (select *, cz * cy * cx as windows, coalesce(sum(cz * cy * cx) over (order by volume rows between unbounded preceding and 1 preceding), 0) as before, sum(cz * cy * cx) over () as total from v),
s as (select slot, t from unnest(range(0, 200)) a(slot), unnest(range(0, 3)) b(t)), d as (select slot, t, cast(floor({_uniform("'7:' || slot || ':' || t")} * total) as bigint) as pl, total from s, (select max(total) as total from k)),
w as (select slot, t, volume, pl - before as i, cy, cx from d join k on pl >= before and pl < before + windows), p as (select slot, t, volume, i // (cy * cx) as z, i // cx % cy * 2 as y, i % cx * 2 as x from w),
m as (select p.*, (select count(*) from voxels o where p.volume = 'a' and img > 0.8::double and o.z between p.z and p.z + 1 and o.y between p.y and p.y + 5 and o.x between p.x and p.x + 5) >= 8 as valid from p),
r as (select *, row_number() over (partition by slot order by not valid, case when valid then t else -t end) as r from m)"""


@query("sampled_windows", _DRAWS + " select slot, cast(t as integer) as try, volume, cast(z as integer) as z, cast(y as integer) as y, cast(x as integer) as x, valid from r where r = 1")
def sampled_windows(spark, sf_dir):
    """200 windows of two volumes, each drawn up to three times until it holds eight bright voxels."""
    v = voxels(spark, sf_dir).select("z", "y", "x", (F.col("img") > 0.8).cast("int").alias("fg"))
    size = grid.shape(v)
    volumes = size.select(F.lit("a").alias("volume"), "nz", "ny", "nx").unionByName(size.select(F.lit("b").alias("volume"), F.expr("nz div 2 + 1").alias("nz"), F.lit(10).alias("ny"), F.lit(8).alias("nx")))
    draws = sampling.window_draws(volumes, (2, 6, 6), (1, 2, 2), 200, 7, 3)
    bright = sampling.all_in(v, "fg", (2, 6, 6), (1, 2, 2), 8).withColumn("volume", F.lit("a"))
    return sampling.first_accepted(draws, bright)


@query("cycled_chunks", merge._BLOCKS + f"""n as (select count(*) as n from blocks), r as (select idx, round, n, row_number() over (partition by round order by {_uniform("'3:' || round || ':' || idx")}, idx) - 1 as o
from blocks, n, unnest(range(0, 500)) a(round) where round * n < 500) select round * n + o as step, idx from r where round * n + o < 500""".replace("n as (select count", ", n as (select count", 1))
def cycled_chunks(spark, sf_dir):
    """500 steps over all blocks, each taken once before any comes again."""
    return sampling.cycled(merge.block_grid(spark, sf_dir), "idx", 500, 3)


@query("weighted_objects", f""", s as (select seg, count(*) as size from voxels where seg <> 0 group by seg) select seg, size from s order by -ln(1 - {_uniform("'11:' || seg")}) / size, seg limit 12""")
def weighted_objects(spark, sf_dir):
    """Twelve objects, drawn by their sizes."""
    return sampling.weighted_sample(labels.sizes(voxels(spark, sf_dir), "seg"), ["seg"], "size", 12, 11)


@query("chunk_store_box", "select z, y, x, seg as value from voxels where z < 9 and y >= 3 and y < 17 and x >= 6")
def chunk_store_box(spark, sf_dir):
    """A volume written as compressed chunks; a box of it is read back."""
    v, path = voxels(spark, sf_dir).select("z", "y", "x", "seg"), scratch(spark, "chunks")
    size = grid.shape(v).first()
    chunks.write_chunks(v, path, "seg", "uint64", (4, 8, 8), (size["nz"], size["ny"], size["nx"]))
    return chunks.read_chunks(spark, path, low=(0, 3, 6), high=(9, 17, size["nx"]), background=True)
