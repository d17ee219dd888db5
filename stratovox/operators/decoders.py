"""From predicted maps to instances: connectivity by corners, small objects given to neighbours, synapses, seeded flooding of blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators import labels, stencils
from stratovox.operators.grid import running_before
from stratovox.operators.kernels import Grid, block_array, flooded, squared_distances
from stratovox.operators.targets import half_ball
from stratovox.sources.volumes import AXES, dense


def above(score: Column, threshold: float, levels: int = 255) -> Column:
    """Foreground of a score in whole numbers to ``levels``: strictly above the threshold, which is cut to a whole number first."""
    return score > int(levels * threshold)


def fully_connected(volume: DataFrame, label: str, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, component``: as :func:`labels.grid_components`, but voxels also touch by an edge or a corner. Only labelled rows are read and returned."""
    rows = labels.linear_index(volume.where(F.col(label) != 0).select(*AXES, label), size)
    return labels.touching(rows, label, half_ball(1.8))


def given_to_neighbours(volume: DataFrame, label: str, smallest: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Objects of fewer than ``smallest`` voxels take the most frequent other label (0 only if there is no other) in the ring of one voxel around them
    in the slice, the least on ties. All objects are judged on the volume as it came; ``by`` counts within slices."""
    rows = dense(volume.select(*AXES, label))
    small = labels.sizes(rows, label, by).where(F.col("size") < smallest).select(label, *by)
    offsets = F.array(*(F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in (-1, 0, 1) for x in (-1, 0, 1) if y or x))
    reach = rows.where(F.col(label) != 0).join(small, [label, *by]).select("z", F.col(label).alias("own_"), F.explode(offsets).alias("o"), "y", "x")
    ring = reach.select("z", (F.col("y") + F.col("o.y")).alias("y"), (F.col("x") + F.col("o.x")).alias("x"), "own_").distinct()
    met = ring.join(rows.hint("merge"), list(AXES)).where(F.col(label) != F.col("own_"))
    key = ["own_", *by]
    counts = met.groupBy(*key, label).agg(F.count("*").alias("n"))
    best = counts.groupBy(*key).agg(F.max(F.struct((F.col(label) != 0).alias("some"), "n", (-F.col(label)).alias("l"))).alias("b"))
    table = best.select(F.col("own_").alias(label), *by, (-F.col("b.l")).alias("new_"))
    return labels.joined_by_label(rows, label, table, *by).select(*AXES, F.coalesce("new_", label).alias(label))


def paired_synapses(volume: DataFrame, sender: Column, receiver: Column, either: Column, reach: int = 2, smallest: int = 0) -> DataFrame:
    """``z, y, x, id``: 2n-1 for the sending and 2n for the receiving side of the n-th synapse, by its component's number.

    A synapse is a component (by corners) of the union grown by ``reach`` in the slice; sides of fewer than ``smallest``
    voxels (by faces) are dropped. Where both sides meet the receiving side wins.
    """
    rows = dense(volume.select(*AXES, (sender & either).cast("int").alias("pre"), (receiver & either).cast("int").alias("post"), either.cast("int").alias("any_")))
    grown = stencils.box(rows, "any_", (0, reach, reach), "max", "grown", filled=True).select(*AXES, "grown")
    whole = labels.compacted(fully_connected(grown, "grown"), "component").withColumnRenamed("component", "n_")
    out = rows.join(whole.hint("merge"), list(AXES), "left")
    for side in ("pre", "post"):
        if smallest:
            parts = labels.size_filtered(labels.grid_components(rows.select(*AXES, side), side), "component", smallest=smallest)
            out = out.join(parts.withColumnRenamed("component", f"{side}_").hint("merge"), list(AXES), "left").withColumn(side, (F.coalesce(f"{side}_", F.lit(0)) != 0).cast("int"))
    n = F.coalesce("n_", F.lit(0)).cast("long")
    return out.select(*AXES, F.when(F.col("post") == 1, 2 * n).when(F.col("pre") == 1, 2 * n - 1).otherwise(F.lit(0)).cast("long").alias("id"))


def small_in_slices(volume: DataFrame, label: str, largest: int | tuple[int, int, int]) -> DataFrame:
    """``z, y, x, small``: 1 where the voxel's component within a slice across some axis (by faces, of one label) has fewer than ``largest`` voxels, for all
    axes or for each."""
    marks = None
    for axis, largest in zip(AXES, largest if isinstance(largest, tuple) else (largest,) * 3):
        # components of one slice: the slice is part of the label, so that slices don't touch
        rows = volume.select(*AXES, F.when(F.col(label) != 0, F.struct(F.col(axis).alias("slice"), F.col(label).alias("l"))).alias("key_")).where("key_ is not null")
        parts = in_slices(rows, axis)
        sizes = parts.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") < largest).select("component")
        found = parts.join(sizes.hint("merge"), "component").select(*AXES)
        marks = found if marks is None else marks.unionByName(found)
    marks = marks.distinct().withColumn("mark_", F.lit(1))
    return volume.select(*AXES).join(marks.hint("merge"), list(AXES), "left").select(*AXES, F.coalesce("mark_", F.lit(0)).alias("small"))


def in_slices(rows: DataFrame, axis: str) -> DataFrame:
    """``z, y, x, component`` of face neighbours with equal ``key_`` within slices across ``axis``."""
    faces = [tuple(-int(a == b) for b in AXES) for a in AXES if a != axis]
    return labels.touching(labels.linear_index(rows.withColumn("l_", F.col("key_").getField("l"))), "l_", faces)


def peaks(inside: np.ndarray, spacing: tuple[float, ...]) -> np.ndarray:
    """Seeds of a mask: places whose distance to the outside is greatest among their neighbours; touching ones are one seed, numbered in order."""
    found = squared_distances(~inside, spacing)
    found[~np.isfinite(found)] = 1.0
    most = found.copy()
    for axis in range(found.ndim):
        padded = np.pad(most, [(1, 1) if a == axis else (0, 0) for a in range(found.ndim)], constant_values=-1)
        parts = [np.take(padded, range(k, k + found.shape[axis]), axis) for k in range(3)]
        most = np.maximum(np.maximum(parts[0], parts[1]), parts[2])
    return numbered(inside & (found == most))


def numbered(mask: np.ndarray) -> np.ndarray:
    """Components of a mask by faces, numbered in row-major order of their first cell."""
    out, n = np.zeros(mask.shape, np.int64), 0
    for start in zip(*np.nonzero(mask)):
        if out[start]:
            continue
        n += 1
        out[start], stack = n, [start]
        while stack:
            at = stack.pop()
            for axis in range(mask.ndim):
                for d in (-1, 1):
                    to = (*at[:axis], at[axis] + d, *at[axis + 1 :])
                    if 0 <= to[axis] < mask.shape[axis] and mask[to] and not out[to]:
                        out[to] = n
                        stack.append(to)
    return out


def flooded_in_mask(height: np.ndarray, seeds: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Seeded flooding that stays inside the mask; cells that no seed reaches are 0."""
    walls = np.where(mask, height, np.inf)
    found = flooded(walls, np.where(mask, seeds, 0)) if (seeds * mask).any() else np.zeros(mask.shape, np.int64)
    reached = numbered_by(found, mask, seeds)
    return np.where(mask & reached, found, 0)


def numbered_by(found: np.ndarray, mask: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Where a seed is reached inside of the mask."""
    parts = numbered(mask)
    held = np.unique(parts[mask & (seeds > 0)])
    return np.isin(parts, held[held > 0])


def watershed_instances(rows: DataFrame, score: str, contour: str | None, seed_above: float, mask_above: float, contour_below: float, smallest_seed: int, grid: Grid | None = None) -> DataFrame:
    """``block, z, y, x, id``: each block's foreground (``score`` above ``mask_above``) flooded over ``-score`` from the components of seeds: scores
    above ``seed_above`` where the contour is below ``contour_below``; seeds of fewer voxels than ``smallest_seed`` are dropped."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        value, place = block_array(block, score, 0.0, grid)
        seeds = value > seed_above
        if contour is not None:
            seeds &= block_array(block, contour, 0.0, grid)[0] < contour_below
        marks = numbered(seeds)
        size = np.bincount(marks.ravel())
        marks[size[marks] < smallest_seed] = 0
        found = flooded_in_mask(-value, marks, value > mask_above)
        return block[["block", *AXES]].assign(id=found[place])

    return rows.groupBy("block").applyInPandas(run, "block long, z int, y int, x int, id long")


def split_object(rows: DataFrame, label: str, index: int, spacing: tuple[float, float, float], first_new: int, grid: Grid | None = None) -> DataFrame:
    """``block, z, y, x, label`` of all blocks: the object ``index`` is cut, in each block, into the basins of its distance's peaks; the first
    keeps the id, others count on from ``first_new``, block by block, so that no two blocks give one id."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        value, place = block_array(block, label, 0, grid)
        inside = value == index
        marks = peaks(inside, spacing)
        basins = flooded_in_mask(-squared_distances(~inside, spacing), marks, inside)
        return block[["block", *AXES, label]].assign(part_=np.where(inside, basins, 0)[place])

    parts = labels.saved(rows.groupBy("block").applyInPandas(run, f"block long, z int, y int, x int, {label} long, part_ long"), "parts")
    more = parts.groupBy("block").agg(F.greatest(F.max("part_") - 1, F.lit(0)).alias("n_"))
    before = running_before(more, "block", "n_", "before_").select("block", "before_")
    new = F.when(F.col("part_") > 1, first_new + F.col("before_") + F.col("part_") - 2).otherwise(F.col(label))
    return parts.join(before, "block").select("block", *AXES, new.cast("long").alias(label))
