"""Queries of crops, patches, windows and padding."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import crops, labels
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels

_I = lambda *names: ", ".join(f"cast({e} as integer) as {n}" for n, e in names)


def _seg(spark, sf_dir):
    return voxels(spark, sf_dir).select("z", "y", "x", "seg")


@query("crop_inclusive", "select z - 1 as z, y - 2 as y, x - 3 as x, seg from voxels where z between 1 and 9 and y between 2 and 12 and x between 3 and 20")
def crop_inclusive(spark, sf_dir):
    return crops.crop(_seg(spark, sf_dir), (1, 2, 3), (9, 12, 20), inclusive=True)


@query("crop_padded", """, g as (select a.z, b.y, c.x from (select unnest(range(0, 4)) as z) a, (select unnest(range(-3, 15)) as y) b, (select unnest(range(10, 30)) as x) c)
select cast(g.z as integer) as z, cast(g.y + 3 as integer) as y, cast(g.x - 10 as integer) as x, case when v.z is null then 128 when v.msk then v.seg else 0 end as seg
from g left join voxels v on v.z = g.z and v.y = g.y and v.x = g.x""")
def crop_padded(spark, sf_dir):
    """A box that reaches outside: 128 there, 0 outside of the mask."""
    return crops.padded_crop(voxels(spark, sf_dir), "seg", (0, -3, 10), (4, 15, 30), 128, F.col("msk"))


@query("paste_with_background", """, p as (select z, cast(y + 4 as integer) as y, cast(x + 6 as integer) as x, seg % 3 as s from voxels where y < 8 and x < 8)
select v.z, v.y, v.x, coalesce(p.s, v.seg) as seg from voxels v left join p on p.z = v.z and p.y = v.y and p.x = v.x""")
def paste_with_background(spark, sf_dir):
    v = _seg(spark, sf_dir)
    patch = v.where("y < 8 and x < 8").withColumn("seg", F.expr("seg % 3"))
    return crops.pasted(v, patch, "seg", (0, 4, 6), background=True)


@query("windows_of_size", """, b as (select seg, min(y) as lo, max(y) + 1 as hi from voxels where seg <> 0 group by seg)
select seg, cast(case when hi - lo >= 12 then lo + abs(12 - (hi - lo)) // 2 else lo - abs(12 - (hi - lo)) // 2 end as integer) as low,
cast(case when hi - lo >= 12 then lo + abs(12 - (hi - lo)) // 2 else lo - abs(12 - (hi - lo)) // 2 end + 12 as integer) as high from b""")
def windows_of_size(spark, sf_dir):
    """A window of twelve rows around each label's box."""
    low, high = crops.window_of_size(F.col("y_min"), F.col("y_max") + 1, 12)
    return labels.boxes(voxels(spark, sf_dir), "seg").select("seg", low.alias("low"), high.alias("high"))


@query("centre_crop", "select z, y - 5 as y, x - 7 as x, seg from voxels where y >= 5 and y < 15 and x >= 7 and x < 17 and z < (select max(z) + 1 from voxels)")
def centre_crop(spark, sf_dir):
    v = _seg(spark, sf_dir)
    depth = v.agg(F.max("z") + 1).first()[0]
    return crops.centre_crop(v, (depth, 10, 10))


@query("unpad_borders", "select z, y - 2 as y, x - 1 as x, seg from voxels where y >= 2 and y < 17 and x >= 1 and x < 21")
def unpad_borders(spark, sf_dir):
    return crops.unpadded(_seg(spark, sf_dir), [0, 0, 2, 3, 1, 4])


_PAD = """, s as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels),
tz as (select unnest(range(-1, nz + 1)) as t, nz as n from s), ty as (select unnest(range(-2, ny + 2)) as t, ny as n from s), tx as (select unnest(range(-3, nx + 3)) as t, nx as n from s)
select cast(tz.t + 1 as integer) as z, cast(ty.t + 2 as integer) as y, cast(tx.t + 3 as integer) as x, seg from tz, ty, tx, voxels v where """


@query("symmetric_pad", _PAD + " and ".join(f"v.{a} = case when t{a}.t < 0 then -1 - t{a}.t when t{a}.t >= t{a}.n then 2 * t{a}.n - 1 - t{a}.t else t{a}.t end" for a in "zyx"))
def symmetric_pad(spark, sf_dir):
    return crops.padded(_seg(spark, sf_dir), [1, 2, 3], "symmetric")


@query("edge_pad", _PAD + " and ".join(f"v.{a} = least(greatest(t{a}.t, 0), t{a}.n - 1)" for a in "zyx"))
def edge_pad(spark, sf_dir):
    return crops.padded(_seg(spark, sf_dir), [1, 2, 3], "edge")


@query("sliding_patches", """, y0 as (select unnest(range(0, 16, 5)) as y0), x0 as (select unnest(range(0, 21, 5)) as x0)
select z, cast(y0 as integer) as y0, cast(x0 as integer) as x0, cast((y - y0) * 5 + x - x0 as integer) as place, seg from y0, x0, voxels where y >= y0 and y < y0 + 5 and x >= x0 and x < x0 + 5""")
def sliding_patches(spark, sf_dir):
    return crops.sliding_patches(_seg(spark, sf_dir), "seg", (5, 5), 5)
