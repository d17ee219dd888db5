"""Queries of grids and of the overlap merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import grid, overlap
from stratovox.plans.registry import query
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import voxels

BLOCK, OVERLAP = (8, 8, 8), (2, 2, 2)

_BLOCKS = """,
s as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels),
gz as (select unnest(range(0, nz, 6)) as z1, nz from s), gy as (select unnest(range(0, ny, 6)) as y1, ny from s), gx as (select unnest(range(0, nx, 6)) as x1, nx from s),
blocks as (select row_number() over (order by z1, y1, x1) - 1 as idx, cast(z1 as integer) as z1, cast(least(z1 + 8, nz) as integer) as z2, cast(y1 as integer) as y1,
  cast(least(y1 + 8, ny) as integer) as y2, cast(x1 as integer) as x1, cast(least(x1 + 8, nx) as integer) as x2 from gz, gy, gx)
"""
_LOCAL = _BLOCKS + """,
bv as (select idx, z, y, x, case when img < cast(0.05 as double) then 0 else gt end as g from voxels join blocks on z >= z1 and z < z2 and y >= y1 and y < y2 and x >= x1 and x < x2),
ranks as (select idx, g, row_number() over (partition by idx order by g) as id from (select distinct idx, g from bv where g <> 0)),
loc as (select bv.idx, z, y, x, coalesce(id, 0) as id from bv left join ranks on bv.idx = ranks.idx and bv.g = ranks.g),
mx as (select idx, max(id) as max_id from loc group by idx),
offs as (select idx, max_id, cast(1 + coalesce(sum(max_id) over (order by idx rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from mx)
"""
_GLOBAL = _LOCAL + """,
gl as (select loc.idx, z, y, x, case when id <> 0 then id + "offset" else 0 end as id from loc join offs on loc.idx = offs.idx),
pc as (select l.idx as i, r.idx as j, l.id as a, r.id as b, count(*) as n from gl l join gl r on l.z = r.z and l.y = r.y and l.x = r.x and l.idx < r.idx where l.id <> 0 and r.id <> 0 group by all)
"""
_SELECTED = _GLOBAL + """,
tot as (select *, cast(sum(n) over (partition by i, j, a) as bigint) as total_a, cast(sum(n) over (partition by i, j, b) as bigint) as total_b from pc),
sel as (select * from tot where n >= 5 and total_b <= 1500000 and not (n::double / total_a < 0.5 and n::double / total_b < 0.5))
"""
_REPS = _SELECTED + """,
e as (select a, b from sel union select b, a from sel),
reach(node, label) as (select a, a from e union select e.b, reach.label from reach join e on e.a = reach.node where reach.label < e.b),
reps as (select node as id, min(label) as rep from reach group by node)
"""


def _labelled(spark, sf_dir):
    objects = voxels(spark, sf_dir).select("z", "y", "x", F.when(F.col("img") < 0.05, F.lit(0)).otherwise(F.col("gt")).alias("g"))
    return overlap.local_ids(grid.in_blocks(objects, BLOCK, OVERLAP), "g")


def _offsets(local):
    return overlap.offsets(overlap.block_sizes(local))


def _global(spark, sf_dir):
    local = saved(_labelled(spark, sf_dir), "local")
    return overlap.with_offsets(local, _offsets(local))


@query("block_grid", _BLOCKS + "select * from blocks")
def block_grid(spark, sf_dir):
    return grid.blocks(grid.shape(voxels(spark, sf_dir)), BLOCK, OVERLAP)


@query("chunk_grid", """,
s as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels),
k as (select unnest(range(0, 10000)) as c),
gz as (select c as cz, c * 6 as z1, nz from k, s where c = 0 or (c - 1) * 6 + 8 < nz), gy as (select c as cy, c * 6 as y1, ny from k, s where c = 0 or (c - 1) * 6 + 8 < ny),
gx as (select c as cx, c * 6 as x1, nx from k, s where c = 0 or (c - 1) * 6 + 8 < nx)
select cast(cz as integer) as cz, cast(cy as integer) as cy, cast(cx as integer) as cx, cast(z1 as integer) as z1, cast(least(z1 + 8, nz) as integer) as z2,
  cast(y1 as integer) as y1, cast(least(y1 + 8, ny) as integer) as y2, cast(x1 as integer) as x1, cast(least(x1 + 8, nx) as integer) as x2 from gz, gy, gx""")
def chunk_grid(spark, sf_dir):
    return grid.chunks(grid.shape(voxels(spark, sf_dir)), BLOCK, OVERLAP)


@query("block_offsets", _LOCAL + "select * from offs")
def block_offsets(spark, sf_dir):
    return _offsets(saved(_labelled(spark, sf_dir), "local"))


@query("block_overlap_pairs", _BLOCKS + """
select l.idx as i, r.idx as j, greatest(l.z1, r.z1) as z1, least(l.z2, r.z2) as z2, greatest(l.y1, r.y1) as y1, least(l.y2, r.y2) as y2, greatest(l.x1, r.x1) as x1, least(l.x2, r.x2) as x2
from blocks l join blocks r on l.idx < r.idx and greatest(l.z1, r.z1) < least(l.z2, r.z2) and greatest(l.y1, r.y1) < least(l.y2, r.y2) and greatest(l.x1, r.x1) < least(l.x2, r.x2)""")
def block_overlap_pairs(spark, sf_dir):
    return grid.box_pairs(block_grid(spark, sf_dir), BLOCK)


@query("overlap_pair_counts", _GLOBAL + "select * from pc")
def overlap_pair_counts(spark, sf_dir):
    return overlap.pair_counts(_global(spark, sf_dir))


@query("select_union_pairs", _SELECTED + "select * from sel")
def select_union_pairs(spark, sf_dir):
    return overlap.selected(overlap_pair_counts(spark, sf_dir))


@query("id_pools_components", _REPS + "select * from reps")
def id_pools_components(spark, sf_dir):
    return overlap.representatives(select_union_pairs(spark, sf_dir))


@query("overlap_merge", _REPS + """
select z, y, x, max_by(coalesce(rep, gl.id), idx) as id from gl left join reps on gl.id = reps.id group by z, y, x""")
def overlap_merge(spark, sf_dir):
    rows = saved(_global(spark, sf_dir), "global")
    reps = overlap.representatives(overlap.selected(overlap.pair_counts(rows)))
    return overlap.applied(rows, reps)


@query("naive_offset_merge", _GLOBAL + "select z, y, x, max_by(id, idx) as id from gl group by z, y, x")
def naive_offset_merge(spark, sf_dir):
    return _global(spark, sf_dir).groupBy("z", "y", "x").agg(F.max_by("id", "idx").alias("id"))


@query("sliding_positions", """,
s as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels), k as (select unnest(range(0, 10000)) as c),
gz as (select c as iz, least(c * 4, nz - 8) as z from k, s where c < 1 + ceil((nz - 8) / 4)), gy as (select c as iy, least(c * 4, ny - 8) as y from k, s where c < 1 + ceil((ny - 8) / 4)),
gx as (select c as ix, least(c * 4, nx - 8) as x from k, s where c < 1 + ceil((nx - 8) / 4))
select row_number() over (order by iz, iy, ix) - 1 as pos, cast(z as integer) as z, cast(y as integer) as y, cast(x as integer) as x from gz, gy, gx""")
def sliding_positions(spark, sf_dir):
    return grid.window_starts(grid.shape(voxels(spark, sf_dir)), (8, 8, 8), (4, 4, 4))


@query("split_volume", """,
s as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels), k as (select unnest(range(0, 10000)) as c),
gz as (select c as cz, c * 6 as z1 from k, s where c = 0 or (c - 1) * 6 + 8 < nz), gy as (select c as cy, c * 6 as y1 from k, s where c = 0 or (c - 1) * 6 + 8 < ny),
gx as (select c as cx, c * 6 as x1 from k, s where c = 0 or (c - 1) * 6 + 8 < nx)
select cast(cz as integer) as cz, cast(cy as integer) as cy, cast(cx as integer) as cx, cast(z - z1 as integer) as lz, cast(y - y1 as integer) as ly, cast(x - x1 as integer) as lx, seg
from voxels join gz on z >= z1 and z < z1 + 8 join gy on y >= y1 and y < y1 + 8 join gx on x >= x1 and x < x1 + 8""")
def split_volume(spark, sf_dir):
    return grid.in_chunks(voxels(spark, sf_dir).select("z", "y", "x", "seg"), BLOCK, OVERLAP)


@query("merge_chunks", "select z, y, x, seg from voxels")
def merge_chunks(spark, sf_dir):
    return grid.merged_chunks(split_volume(spark, sf_dir), ["seg"], BLOCK, OVERLAP)
