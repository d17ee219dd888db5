"""Order-dependent steps on single blocks, as numpy helpers that Spark applies to each block of a volume.

Blocks have a bounded size (that of the block grid), so a task holds one block at a time; results of blocks are
joined by the overlap merge.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.operators.distances import lower_envelope
from stratovox.sources.volumes import AXES


def merged_cheapest_first(edges: pd.DataFrame, threshold: float) -> list[tuple[int, int, float]]:
    """Merges (kept, gone, score) of regions, cheapest edge first, until none scores below ``threshold``.

    ``edges``: ``u, v, total, n``; an edge scores 1 - total / n, and edges that become parallel add up. Ties go by
    (u, v). A region keeps the lesser id.
    """
    near: dict[int, dict[int, tuple[float, int]]] = {}
    heap = []
    for u, v, total, n in edges[["u", "v", "total", "n"]].itertuples(index=False):
        near.setdefault(u, {})[v] = near.setdefault(v, {})[u] = (total, n)
        heap.append((1 - total / n, u, v))
    heapq.heapify(heap)
    out = []
    while heap:
        score, u, v = heapq.heappop(heap)
        if score >= threshold:
            break
        if v not in near.get(u, {}):
            continue
        total, n = near[u][v]
        if 1 - total / n != score:  # changed by a merge since it was pushed
            continue
        out.append((int(u), int(v), float(score)))
        del near[u][v], near[v][u]
        for w, (t, k) in near.pop(v).items():
            del near[w][v]
            if w in near[u]:
                t, k = t + near[u][w][0], k + near[u][w][1]
            near[u][w] = near[w][u] = (t, k)
            heapq.heappush(heap, (1 - t / k, min(u, w), max(u, w)))
    return out


def agglomerated(edges: DataFrame, threshold: float) -> DataFrame:
    """``block, step, kept, gone, score``: the merge history of each block's region graph (``block, u, v, total, n``)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = merged_cheapest_first(rows, threshold)
        return pd.DataFrame({
            "block": pd.Series([rows["block"].iloc[0]] * len(found), dtype="int64"), "step": pd.Series(range(len(found)), dtype="int64"),
            "kept": pd.Series([f[0] for f in found], dtype="int64"), "gone": pd.Series([f[1] for f in found], dtype="int64"), "score": pd.Series([f[2] for f in found], dtype="float64"),
        })

    return edges.groupBy("block").applyInPandas(run, "block long, step long, kept long, gone long, score double")


def squared_distances(outside: np.ndarray, spacing: tuple[float, ...]) -> np.ndarray:
    """Squared distance of each cell to the nearest set cell of ``outside``, axis by axis; infinite if there is none."""
    out = np.where(outside, 0.0, np.inf)
    for axis, step in enumerate(spacing):
        turned = np.moveaxis(out, axis, -1)
        found = lower_envelope(turned.reshape(-1, turned.shape[-1]), step).reshape(turned.shape)
        out = np.moveaxis(found, -1, axis)
    return out


def flooded(height: np.ndarray, seeds: np.ndarray, axes: tuple[int, ...] | None = None, inside: np.ndarray | None = None) -> np.ndarray:
    """Seeded watershed by face neighbours: every cell joins the seed that reaches it over the lowest path; 0 if there are no seeds.

    A step between cells is as high as the higher one; of equal steps the earlier one (by axis, then row-major) counts as lower. Regions without
    a seed all go over their lowest step at once, round by round, as arrays: a round leaves at most half of them. ``axes``: those that steps go along
    (``(1, 2)``: a stack of slices, each by itself). ``inside``: cells that steps may touch.
    """
    index = np.arange(height.size).reshape(height.shape)
    pairs = [(np.take(index, range(n - 1), k).ravel(), np.take(index, range(1, n), k).ravel()) for k, n in enumerate(height.shape) if n > 1 and (axes is None or k in axes)]
    u, v = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in pairs)]) for k in range(2))
    if inside is not None:
        there = inside.ravel()[u] & inside.ravel()[v]
        u, v = u[there], v[there]
    flat, label = height.ravel(), seeds.ravel().astype(np.int64)
    order = np.argsort(np.maximum(flat[u], flat[v]), kind="stable")
    u, v, region = u[order], v[order], index.ravel().copy()
    while True:
        open_ = (u != v) & ((label[u] == 0) | (label[v] == 0))
        u, v = u[open_], v[open_]
        if not len(u):
            return label[region].reshape(height.shape)
        step = np.arange(len(u))[::-1]
        first = np.full(len(label), len(u))
        first[u[::-1]] = step  # of repeated places the last one written, the lowest step, stays
        other = np.full(len(label), len(u))
        other[v[::-1]] = step
        first = np.minimum(first, other)
        own = np.flatnonzero((label == 0) & (first < len(u)))
        to = np.arange(len(label))
        to[own] = u[first[own]] + v[first[own]] - own
        mutual = own[(to[to[own]] == own) & (own < to[own])]
        to[mutual] = mutual
        while (to[to] != to).any():
            to = to[to]
        region, u, v = to[region], to[u], to[v]


@dataclass(frozen=True)
class Grid:
    """The grid that blocks without overlap were cut from: the size of a block, and of the volume."""

    block: tuple[int, int, int]
    shape: tuple[int, int, int]


def block_array(rows: pd.DataFrame, value: str, fill: float, grid: Grid | None = None) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """A block's values as an array and the rows' places in it; missing rows are ``fill``. With a grid the array is the whole block, else the bounding
    box of its rows."""
    first = [int(rows[a].min()) for a in AXES]
    if grid is None:
        size = [int(rows[a].max()) - k + 1 for a, k in zip(AXES, first)]
    else:
        first = [k // b * b for k, b in zip(first, grid.block)]
        size = [min(b, n - k) for k, b, n in zip(first, grid.block, grid.shape)]
    place = tuple((rows[a] - k).to_numpy() for a, k in zip(AXES, first))
    out = np.full(size, fill, rows[value].dtype)
    out[place] = rows[value].to_numpy()
    return out, place


def watershed_blocks(rows: DataFrame, value: str, spacing: int = 4, grid: Grid | None = None) -> DataFrame:
    """``block, z, y, x, id``: each block's slices flooded from a grid of seeds over ``1 - value``; ids go on from slice to slice."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        height, place = block_array(block, value, 0.0, grid)
        seeds = np.zeros(height.shape, np.int64)
        seeds[:, ::spacing, ::spacing] = 1
        seeds[seeds > 0] = np.arange(1, int(seeds.sum()) + 1)
        found = np.stack([flooded(1 - h, s) for h, s in zip(height, seeds)])
        return block[["block", *AXES]].assign(id=found[place])

    return rows.groupBy("block").applyInPandas(run, "block long, z int, y int, x int, id long")


def flooded_blocks(rows: DataFrame, height: str, seed: str, grid: Grid | None = None) -> DataFrame:
    """``block, z, y, x, id``: each block flooded over ``height`` from the seeds it holds (``seed`` above 0), such as those of
    :mod:`stratovox.operators.seeds`; 0 in a block without seeds. Voxels without a row are as high as the greatest number."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        level, place = block_array(block, height, np.finfo(np.float64).max, grid)
        found = flooded(level, block_array(block, seed, 0, grid)[0])
        return block[["block", *AXES]].assign(id=found[place])

    return rows.withColumn(height, F.col(height).cast("double")).withColumn(seed, F.coalesce(F.col(seed).cast("long"), F.lit(0))).groupBy("block").applyInPandas(run, "block long, z int, y int, x int, id long")


def distance_blocks(rows: DataFrame, mask: str, spacing: tuple[float, float, float], grid: Grid | None = None) -> DataFrame:
    """``block, z, y, x, distance`` of masked cells to the nearest unmasked cell of the block (0 if unmasked; -1 if there is none); with a grid, cells
    without a row are unmasked. :func:`stratovox.operators.distances.distance_transform` doesn't stop at borders of blocks."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        inside, place = block_array(block, mask, 0, grid)
        found = np.sqrt(squared_distances(inside == 0, spacing))
        return block[["block", *AXES]].assign(distance=np.where(np.isfinite(found), found, -1.0)[place])

    return rows.groupBy("block").applyInPandas(run, "block long, z int, y int, x int, distance double")


def best_assignment(gain: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows and columns, one to one, with the greatest total gain (shortest augmenting paths with potentials)."""
    turned = gain.shape[0] > gain.shape[1]
    cost = -(gain.T if turned else gain)
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        least, back, seen = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while owner[j0]:
            seen[j0] = True
            open_ = np.nonzero(~seen[1:])[0] + 1
            reduced = cost[owner[j0] - 1, open_ - 1] - u[owner[j0]] - v[open_]
            better = reduced < least[open_]
            least[open_[better]], back[open_[better]] = reduced[better], j0
            j1 = open_[np.argmin(least[open_])]
            step = least[j1]
            u[owner[seen]] += step
            v[seen] -= step
            least[open_] -= step
            j0 = j1
        while j0:
            owner[j0] = owner[back[j0]]
            j0 = back[j0]
    found = [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return [(b, a) for a, b in found] if turned else found


def assigned(pairs: DataFrame, threshold: float) -> DataFrame:
    """``a, b, iou`` of the one-to-one pairs (``group, a, b, iou``, by connected group) that match most objects at ``threshold``, of those with the
    greatest total overlap; pairs below the threshold aren't returned."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        a, i = np.unique(rows["a"], return_inverse=True)
        b, j = np.unique(rows["b"], return_inverse=True)
        gain = np.zeros((len(a), len(b)))
        gain[i, j] = (rows["iou"] >= threshold) + rows["iou"] / (2 * min(gain.shape))
        iou = np.zeros(gain.shape)
        iou[i, j] = rows["iou"]
        kept = [(a[x], b[y], iou[x, y]) for x, y in best_assignment(gain) if iou[x, y] >= threshold and iou[x, y] > 0]
        return pd.DataFrame(kept, columns=["a", "b", "iou"]).astype({"a": "int64", "b": "int64", "iou": "float64"})

    return pairs.groupBy("group").applyInPandas(run, "a long, b long, iou double")


def one_to_one(pairs: DataFrame, order: list) -> DataFrame:
    """Of each overlap's pairs (``i, j, a, b``, best first by ``order``), those whose sides aren't both taken already."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        used_a, used_b, keep = set(), set(), []
        for a, b in rows.sort_values("rank")[["a", "b"]].itertuples(index=False):
            keep.append(not (a in used_a and b in used_b))
            if keep[-1]:
                used_a.add(a)
                used_b.add(b)
        return rows.sort_values("rank")[keep][["i", "j", "a", "b"]]

    from pyspark.sql import Window

    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("i", "j").orderBy(*order))).select("i", "j", "a", "b", "rank")
    return ranked.groupBy("i", "j").applyInPandas(run, "i long, j long, a long, b long")
