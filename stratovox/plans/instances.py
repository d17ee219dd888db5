"""Queries of instance decoders over whole volumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratovox.operators import instances, stencils
from stratovox.plans.holes import _CORNERS, _reach
from stratovox.plans.regions import _boxed
from stratovox.plans.registry import query
from stratovox.sources.volumes import voxels


def _maps(spark, sf_dir):
    """Scores, contours and signed distances as whole numbers to 255."""
    v = voxels(spark, sf_dir)
    edge = stencils.boundaries(v, "gt", 1, filled=True)
    return v.join(edge, ["z", "y", "x"]).select("z", "y", "x", F.floor(F.col("img") * 255).cast("int").alias("score"), (F.col("boundary") * 255).alias("contour"), (F.col("seg") % 256).cast("int").alias("distance"))


_EDGES = ", ed as (select z, y, x, img, cast(" + " or ".join(f"coalesce(lag(gt) over ({w}), gt) <> coalesce(lead(gt) over ({w}), gt)" for w in ("partition by z, x order by y", "partition by z, y order by x")) + " as integer) as v from voxels)"
_CONTOUR, _CONTOURED = _boxed("max", "v", "ed", (0, 1, 1))
_GROWN, _LAST = _boxed("max", "c", "co", (0, 1, 1))
_NUMBERED = "select z, y, x, coalesce(r, 0) as id from {0} left join (select c, row_number() over (order by c) as r from (select c from {0} where c <> 0 group by c having count(*) >= {1})) using (c)"


@query("connected_foreground", ", t as (select z, y, x, 1 as l from voxels where floor(img * 255) > 204)" + _reach("t", _CORNERS) + ", co as (select v.z, v.y, v.x, coalesce(component, 0) as c from voxels v left join (select w.z, w.y, w.x, component from c join w using (i)) k using (z, y, x)) " + _NUMBERED.format("co", 3))
def connected_foreground(spark, sf_dir):
    """Foreground above 0.8 that touches by faces, edges or corners, of three voxels at least."""
    return instances.connected_instances(_maps(spark, sf_dir), "score", above=0.8, smallest=3, size=(20, 25))


@query("connected_without_contour", _EDGES + _CONTOUR + f", t as (select ed.z, ed.y, ed.x, 1 as l from ed join {_CONTOURED} b using (z, y, x) where floor(ed.img * 255) > 191 and b.v = 0)" + _reach("t", _CORNERS)
       + ", co as (select v.z, v.y, v.x, coalesce(component, 0) as c from voxels v left join (select w.z, w.y, w.x, component from c join w using (i)) k using (z, y, x))" + _GROWN + " " + _NUMBERED.format(_LAST, 12))
def connected_without_contour(spark, sf_dir):
    """Foreground without contours, grown by one voxel in the slice, of twelve voxels at least."""
    return instances.connected_instances(_maps(spark, sf_dir), "score", "contour", 0.75, 0.5, (0, 1, 1), 12, size=(20, 25))


@query("flooded_instances")
def flooded_instances(spark, sf_dir):
    """Foreground flooded from seeds by scores, contours and distances; a test compares the parts with plain loops."""
    return instances.flooded_instances(_maps(spark, sf_dir), "score", "contour", "distance", 0.8, 0.8, 0.2, 0.0, -0.9, 1, 2, size=(20, 25))
