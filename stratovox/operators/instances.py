"""From predicted maps to instances, over whole volumes: connected foreground, and floods from connected seeds.

Maps are whole numbers to 255; a threshold t counts as int(255 t), strictly. Missing rows are 0 in every map. Instances are numbered from 1 in
the order of their first voxels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators import decoders, labels, stencils
from stratovox.operators.flooding import seeded_watershed
from stratovox.operators.volumes import resized_nearest
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES, dense

Factor = tuple[float, float, float]


def _maps(volume: DataFrame, **columns: str | None) -> DataFrame:
    return dense(volume.select(*AXES, *(F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(name) for name, c in columns.items() if c)))


def _above(name: str, threshold: float) -> Column:
    return F.col(name) > int(255 * threshold)


def finished(rows: DataFrame, label: str, smallest: int, small_mode: str, factor: Factor | None) -> DataFrame:
    """``z, y, x, id``: instances of fewer than ``smallest`` voxels become background, or are given to their neighbours, or stay (``background``,
    ``neighbor``, ``none``); then ids are numbered, and the grid is scaled by ``factor`` (nearest voxels)."""
    if small_mode == "background":
        rows = labels.size_filtered(rows, label, smallest=smallest)
    elif small_mode == "neighbor":
        rows = decoders.given_to_neighbours(rows, label, smallest)
    elif small_mode != "none":
        raise ValueError(f"unknown mode {small_mode}")
    out = labels.compacted(saved(rows.select(*AXES, label), "instances"), label).withColumnRenamed(label, "id")
    return resized_nearest(out, "id", factor) if factor and factor != (1.0, 1.0, 1.0) else out


def connected_instances(volume: DataFrame, score: str, contour: str | None = None, above: float = 0.8, contour_below: float = 0.5, grow: tuple[int, int, int] = (0, 2, 2), smallest: int = 128,
                        small_mode: str = "background", factor: Factor | None = None, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, id`` of foreground, without contours if there is a map of them, that touches by faces, edges or corners.

    With contours instances grow by ``grow`` voxels to each side; where they meet the later one wins.
    """
    rows = saved(_maps(volume, score=score, contour=contour), "maps")
    inside = _above("score", above)
    if contour:
        inside = inside & (F.col("contour") < int(255 * contour_below))
    found = decoders.fully_connected(rows.where(inside).withColumn("l", F.lit(1)), "l", size)
    out = rows.select(*AXES).join(found.hint("merge"), list(AXES), "left").select(*AXES, F.coalesce("component", F.lit(0)).alias("component"))
    if contour:
        out = stencils.box(out, "component", grow, "max", "grown", filled=True).select(*AXES, F.col("grown").alias("component"))
    return finished(out, "component", smallest, small_mode, factor)


def instance_seeds(rows: DataFrame, inside: Column, smallest: int, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, seed``: voxels of the parts (by faces, edges or corners) of what is ``inside`` that have ``smallest`` voxels at least."""
    found = saved(decoders.fully_connected(rows.where(inside).withColumn("l", F.lit(1)), "l", size), "seeds")
    large = found.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= smallest)
    return found.join(large.select("component").hint("merge"), "component", "left_semi").select(*AXES, F.col("component").alias("seed"))


def flooded_instances(volume: DataFrame, score: str, contour: str | None = None, distance: str | None = None, seed_above: float = 0.9, contour_below: float = 0.8, above: float = 0.85,
                      seed_distance: float = 0.5, distance_above: float = 0.0, seed_size: int = 32, smallest: int = 128, small_mode: str = "background", factor: Factor | None = None,
                      size: tuple[int, int] | None = None, seeds: DataFrame | None = None) -> DataFrame:
    """``z, y, x, id``: foreground flooded from its seeds, the highest scores first; foreground that no seed reaches is background.

    Seeds score above ``seed_above``, have a contour below ``contour_below`` if there is such a map, and a signed distance above ``seed_distance`` if there is
    one (0 to 255 stand for -1 to 1); foreground scores above ``above`` and lies above ``distance_above``. ``seeds`` (``z, y, x, seed``) may be given instead.
    """
    rows = saved(_maps(volume, score=score, contour=contour, distance=distance), "maps")
    ground, core = _above("score", above), _above("score", seed_above)
    if contour:
        core = core & (F.col("contour") < int(255 * contour_below))
    if distance:
        signed = F.col("distance") / F.lit(255.0) * 2.0 - 1.0
        ground, core = ground & (signed > distance_above), core & (signed > seed_distance)
    marks = instance_seeds(rows, core, seed_size, size) if seeds is None else seeds
    open_ = rows.where(ground).select(*AXES, (-F.col("score")).alias("height")).join(marks.hint("merge"), list(AXES), "left")
    found = seeded_watershed(open_, "height", "seed", size)
    out = rows.select(*AXES).join(found.hint("merge"), list(AXES), "left").select(*AXES, F.coalesce("id", F.lit(0)).alias("instance"))
    return finished(out, "instance", smallest, small_mode, factor)
