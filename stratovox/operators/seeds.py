"""Seeds for flooding: regional extrema, and peaks of the distance to the border that keep apart."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.operators import labels, stencils
from stratovox.operators.components import components
from stratovox.operators.distances import distance_transform
from stratovox.operators.quantiles import exact_quantiles
from stratovox.operators.stencils import before
from stratovox.plans.scratch import saved
from stratovox.sources.volumes import AXES


def regional_extrema(volume: DataFrame, value: str, lowest: bool = True, axes: tuple[str, ...] = AXES, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, seed``: voxels of components of equal value that no neighbour outside goes below (``lowest``; else above), with the component's
    least linear index plus 1.

    Neighbours are voxels that share a face along one of ``axes`` (``("y", "x")``: slice by slice). Rows that are missing, or null, are no
    neighbours; a component without neighbours is an extremum. Only rows of extrema are returned.
    """
    rows = saved(labels.linear_index(volume.select(*AXES, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull()), size), "indexed")
    near = F.array(*(before(F.struct("v", "index_"), a, d) for a in axes for d in (1, -1)))
    seen = rows.withColumn("n_", near)
    beyond = F.exists("n_", lambda n: n.isNotNull() & ((n["v"] < F.col("v")) if lowest else (n["v"] > F.col("v"))))
    seen = saved(seen.select(*AXES, "index_", beyond.alias("beyond_"), F.filter("n_", lambda n: (n["v"] == F.col("v")) & (n["index_"] < F.col("index_"))).alias("n_")), "neighbours")
    edges = seen.select("index_", F.explode("n_.index_").alias("near_"))
    roots = components(edges, "index_", "near_").select(F.col("node").alias("index_"), "root")
    named = saved(seen.select(*AXES, "index_", "beyond_").join(roots.hint("merge"), "index_", "left").withColumn("seed", F.coalesce("root", "index_")).drop("root"), "plateaus")
    spoilt = named.where("beyond_").select("seed").distinct()
    return named.join(spoilt.hint("merge"), "seed", "left_anti").select(*AXES, "seed")


#: Voxels of a side of the blocks of :func:`spaced_peaks`.
SIDE = 64
#: States of a peak.
GONE, KEPT, OPEN = 0, 1, 2


def settled(places: np.ndarray, state: np.ndarray, own: np.ndarray, distance: int, side: int) -> np.ndarray:
    """The states of a block's peaks, which come in the order of their indices at ``places`` of a cube of ``side``, where those that aren't its ``own`` stay as
    they are: a peak goes if an earlier one in its box is kept, is kept if all are gone, and else stays open."""
    grid, out = np.zeros((side,) * 3, np.int8), state.copy()
    for k, (z, y, x) in enumerate(places):
        if own[k] and state[k] == OPEN:
            box = grid[z - distance : z + distance + 1, y - distance : y + distance + 1, x - distance : x + distance + 1]
            out[k] = GONE if (box == KEPT).any() else OPEN if box.any() else KEPT
        grid[z, y, x] = out[k]
    return out


def spaced_peaks(volume: DataFrame, value: str, distance: int, index: str = "index_") -> DataFrame:
    """The rows of ``volume`` (``z, y, x``, ``index`` and ``value``) whose value is above 0 and greatest in the box of ``distance`` voxels to each side; of equal
    peaks in each other's box the one of the least index stays.

    A task goes through the peaks of a block in the order of their indices, with those around it; what depends on an open peak of another block is left to
    the next round. Rounds grow with the blocks that a chain of such peaks crosses, not with its peaks.
    """
    most = stencils.box(volume.select(*AXES, value), value, (distance,) * 3, "max", "most_")
    open_ = volume.join(most.where((F.col(value) == F.col("most_")) & (F.col(value) > 0)).select(*AXES).hint("merge"), list(AXES))
    places = [F.col(a).cast("int").alias(a) for a in AXES]
    known = saved(open_.select(*places, F.col(index).cast("long").alias("i_"), F.col(value).cast("double").alias("v_"), F.lit(OPEN).alias("state")), "peaks")
    while not known.where(F.col("state") == OPEN).isEmpty():
        dealt = known
        for a in AXES:
            low, high = (F.floor((F.col(a) + d) / SIDE).cast("int") for d in (-distance, distance))
            dealt = dealt.withColumn(f"b{a}", F.explode(F.sequence(low, high)))

        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("i_")
            inside = np.stack([(part[a] - part[f"b{a}"] * SIDE).to_numpy() for a in AXES], axis=1)
            own = np.all((inside >= 0) & (inside < SIDE), axis=1)
            part = part.assign(state=settled(inside + 2 * distance, part["state"].to_numpy(), own, distance, SIDE + 4 * distance))
            return part.loc[own, [*AXES, "i_", "v_", "state"]]

        known = saved(dealt.groupBy(*(f"b{a}" for a in AXES)).applyInPandas(run, "z int, y int, x int, i_ long, v_ double, state int"), "peaks")
    return known.where(F.col("state") == KEPT).select(*AXES, F.col("i_").alias(index), F.col("v_").alias(value))


def interior_seeds(volume: DataFrame, boundary: str, threshold: float = 0.4, distance: int = 15, share: float = 0.7, size: tuple[int, int] | None = None) -> DataFrame:
    """``z, y, x, seed``: peaks of the distance to the border of the interior, numbered from 1 in row-major order.

    The interior is where 1 - ``boundary`` is above ``threshold``, or, if that is nowhere so, above its quantile ``share``. If there are no peaks
    (an interior without a border), its first voxel of the greatest distance is the only seed; an empty interior has none.
    """
    inner = saved(labels.linear_index(volume.select(*AXES, (1 - F.col(boundary)).alias("inner_")), size), "interior")
    if inner.where(F.col("inner_") > threshold).isEmpty():
        found = exact_quantiles(inner, "inner_", [share])
        threshold = found[0] if found else threshold
    mask = inner.where(F.col("inner_") > threshold)
    far = distance_transform(inner, F.col("inner_") > threshold).join(mask.select(*AXES, "index_").hint("merge"), list(AXES))
    far = saved(far.select(*AXES, "index_", "distance"), "distances")
    peaks = spaced_peaks(far, "distance", distance)
    if peaks.isEmpty():
        peaks = far.orderBy(F.desc("distance"), "index_").limit(1)
    ranked = labels.running_before(saved(peaks.select(*AXES, "index_").withColumn("one_", F.lit(1)), "seeds"), "index_", "one_", "rank_")
    return ranked.select(*AXES, (F.col("rank_") + 1).alias("seed"))
