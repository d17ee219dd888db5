"""Merging of a block's regions, cheapest edge first, with composable edge statistics.

Spark sums up each edge's faces and hands a block's edges to one task, a row an edge; blocks have a bounded size.
Statistics of an edge are kept in a form that merges: extremes, sums, histograms, greatest values. When two edges become
parallel the dearer one goes into the cheaper one, which keeps its place in the queue and is scored again only when it
comes up there. :mod:`stratovox.operators.agglomeration` merges regions of a whole volume.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratovox.operators.kernels import Grid, block_array, flooded
from stratovox.operators.stencils import before
from stratovox.sources.volumes import AXES


@dataclass
class Statistics:
    """What an edge's faces amount to; ``values`` holds the greatest affinity of each first edge that was merged into it."""

    low: float
    high: float
    total: float
    faces: int
    histogram: np.ndarray
    greatest: list[float]
    values: list[float] = field(default_factory=list)

    def add(self, other: Statistics, keep: int) -> None:
        self.low, self.high = min(self.low, other.low), max(self.high, other.high)
        self.total += other.total
        self.faces += other.faces
        self.histogram = self.histogram + other.histogram
        self.greatest = heapq.nlargest(keep, self.greatest + other.greatest)
        self.values = self.values + other.values


@dataclass(frozen=True)
class Scorer:
    """A score of an edge's statistics (lower merges first), and the bins and greatest values that have to be kept for it.

    ``from_greatest``: a first edge's histogram counts its greatest face only, once, as that of its quantile does.
    """

    score: Callable[[Statistics], float]
    bins: int = 1
    keep: int = 1
    from_greatest: bool = True


def _from_histogram(counts: np.ndarray, quantile: int) -> float:
    running = np.cumsum(counts)
    return (int(np.searchsorted(running, quantile * running[-1] // 100 + 1)) + 0.5) / len(counts)


def _from_values(values: list[float], quantile: int) -> float:
    ranked = sorted(values)
    return ranked[min(quantile * len(ranked) // 100, len(ranked) - 1)]


def scorer(name: str, from_greatest: bool = True) -> Scorer:
    """A scorer by its short name: ``min``, ``max``, ``mean``, ``contact``, ``maxK`` (mean of the K greatest), ``affQ_hisB`` (the quantile Q of
    B bins), ``affQ`` or ``affQ_his0`` (the quantile of first edges' greatest affinities). All but ``contact`` score one minus the statistic.
    ``from_greatest`` false: histograms start with all faces of an edge."""
    plain = {"min": lambda s: 1 - s.low, "max": lambda s: 1 - s.high, "mean": lambda s: 1 - s.total / s.faces, "contact": lambda s: 1.0 / s.faces}
    if name in plain:
        return Scorer(plain[name])
    if found := re.fullmatch(r"max(\d+)", name):
        return Scorer(lambda s: 1 - sum(s.greatest) / len(s.greatest), keep=int(found[1]))
    if found := re.fullmatch(r"aff(\d+)(?:_his(\d+))?", name):
        quantile, bins = int(found[1]), int(found[2] or 0)
        if bins:
            return Scorer(lambda s: 1 - _from_histogram(s.histogram, quantile), bins=bins, from_greatest=from_greatest)
        return Scorer(lambda s: 1 - _from_values(s.values, quantile))
    raise ValueError(f"unknown scorer {name}")


def first_statistics(affinities: list[float], rule: Scorer) -> Statistics:
    a = np.asarray(affinities, float)
    counted = a.max(keepdims=True) if rule.from_greatest else a
    bins = np.bincount(np.minimum((counted * rule.bins).astype(int), rule.bins - 1), minlength=rule.bins)
    return Statistics(float(a.min()), float(a.max()), float(a.sum()), len(a), bins, heapq.nlargest(rule.keep, a.tolist()), [float(a.max())])


class Merging:
    """A region graph that merges further and further as the threshold rises.

    Every live edge has one entry in the queue, with the score that is stored for it; of equal scores the earlier edge comes first.
    """

    def __init__(self, edges: dict[tuple[int, int], Statistics], rule: Scorer):
        self.rule, self.rep, self.history, self.reached = rule, {}, [], -np.inf
        self.near: dict[int, dict[int, int]] = {}
        self.statistics, self.stored, self.ends, self.stale = [], [], [], []
        for e, ((u, v), s) in enumerate(sorted(edges.items())):
            self.near.setdefault(u, {})[v] = self.near.setdefault(v, {})[u] = e
            self.statistics.append(s)
            self.stored.append(rule.score(s))
            self.ends.append((u, v))
            self.stale.append(False)
        self.queue = [(score, e) for e, score in enumerate(self.stored)]
        heapq.heapify(self.queue)

    def find(self, region: int) -> int:
        while region in self.rep:
            region = self.rep[region]
        return region

    def until(self, threshold: float) -> None:
        """Merge the cheapest edge again and again while it scores below ``threshold``; a lower threshold than before does nothing."""
        self.reached = max(self.reached, threshold)
        while self.queue and self.queue[0][0] < threshold:
            score, e = heapq.heappop(self.queue)
            if self.statistics[e] is None:  # went into another edge
                continue
            if self.stale[e]:
                self.stored[e], self.stale[e] = self.rule.score(self.statistics[e]), False
                heapq.heappush(self.queue, (self.stored[e], e))
            else:
                self._merge(e, score)

    def _merge(self, e: int, score: float) -> None:
        u, v = self.ends[e]
        self.history.append((u, v, score))
        self.rep[v] = u
        self.statistics[e] = None
        del self.near[u][v], self.near[v][u]
        for w, moved in self.near.pop(v).items():
            del self.near[w][v]
            kept, own = moved, self.near[u].get(w)
            if own is not None:
                kept, gone = (own, moved) if self.stored[moved] > self.stored[own] else (moved, own)
                self.statistics[kept].add(self.statistics[gone], self.rule.keep)
                self.statistics[gone], self.stale[kept] = None, True
            self.near[u][w] = self.near[w][u] = kept
            self.ends[kept] = (u, w) if u < w else (w, u)

    def graph(self) -> list[tuple[int, int, float]]:
        """Live edges with their scores, but for those that have fallen below the threshold since they were scored."""
        live = [(*self.ends[e], self.rule.score(s) if self.stale[e] else self.stored[e]) for e, s in enumerate(self.statistics) if s is not None]
        return sorted(x for x in live if x[2] >= self.reached)


def block_faces(rows: DataFrame, label: str, affinities: dict[str, str]) -> DataFrame:
    """``block, u, v, aff``: faces between different regions of one block (u < v, neither 0); ``affinities``: a column for each axis."""
    near = [F.struct(before(label, a, 1, "block").alias("o"), F.col(affinities[a]).alias("aff")) for a in AXES]
    found = rows.withColumn("n_", F.array(*near)).select("block", F.col(label).alias("p"), F.explode("n_").alias("n"))
    found = found.where((F.col("p") != 0) & (F.col("n.o") != 0) & (F.col("p") != F.col("n.o")))
    return found.select("block", F.least("p", "n.o").alias("u"), F.greatest("p", "n.o").alias("v"), F.col("n.aff").cast("double").alias("aff"))


def first_edges(faces: DataFrame, rule: Scorer) -> DataFrame:
    """One row for each first edge of a block: ``block, u, v, low, high, total, faces``, and what ``rule`` needs besides: ``bins`` (bin and count, where
    all faces are counted) and ``greatest`` (the ``keep`` greatest affinities). Summed up before anything is handed to Python."""
    key, parts = ["block", "u", "v"], faces
    own = [F.min("aff").alias("low"), F.max("aff").alias("high"), F.sum("aff").alias("total"), F.count("*").alias("faces")]
    if rule.keep > 1:
        ranked = parts.withColumn("r_", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("aff"))))
        return ranked.groupBy(*key).agg(*own, F.collect_list(F.when(F.col("r_") <= rule.keep, F.col("aff"))).alias("greatest"))
    if rule.bins > 1 and not rule.from_greatest:
        bin_of = F.least(F.floor(F.col("aff") * rule.bins), F.lit(rule.bins - 1)).cast("int")
        binned = parts.groupBy(*key, bin_of.alias("bin")).agg(*own)
        return binned.groupBy(*key).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("faces").alias("faces"), F.collect_list(F.struct("bin", F.col("faces").alias("n"))).alias("bins"))
    return parts.groupBy(*key).agg(*own)


def _edges(rows: pd.DataFrame, rule: Scorer) -> dict[tuple[int, int], Statistics]:
    found = {}
    for r in rows.itertuples(index=False):
        histogram = np.zeros(rule.bins, np.int64)
        if rule.bins > 1 and not rule.from_greatest:
            for x in r.bins:
                histogram[x["bin"]] = x["n"]
        else:
            histogram[min(int(r.high * rule.bins), rule.bins - 1)] = 1
        greatest = sorted(r.greatest, reverse=True) if rule.keep > 1 else [r.high]
        found[int(r.u), int(r.v)] = Statistics(r.low, r.high, r.total, int(r.faces), histogram, greatest, [r.high])
    return found


def agglomerated(faces: DataFrame, thresholds: list[float], name: str, from_greatest: bool = True) -> DataFrame:
    """``block, threshold, id, rep`` of every region that was merged into another, at each of the rising thresholds, in one run of each block."""
    rising, rule = sorted(thresholds), scorer(name, from_greatest)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        merging, out = Merging(_edges(rows, rule), rule), []
        for t in rising:
            merging.until(t)
            out += [(t, r, merging.find(r)) for r in sorted(merging.rep)]
        found = pd.DataFrame(out, columns=["threshold", "id", "rep"]).astype({"threshold": "float64", "id": "int64", "rep": "int64"})
        found.insert(0, "block", np.int64(rows["block"].iloc[0]))
        return found

    return first_edges(faces, rule).groupBy("block").applyInPandas(run, "block long, threshold double, id long, rep long")


def merge_history(faces: DataFrame, threshold: float, name: str, from_greatest: bool = True) -> DataFrame:
    """``block, step, kept, gone, score`` of every merge."""
    rule = scorer(name, from_greatest)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        merging = Merging(_edges(rows, rule), rule)
        merging.until(threshold)
        found = pd.DataFrame(merging.history, columns=["kept", "gone", "score"]).astype({"kept": "int64", "gone": "int64", "score": "float64"})
        found.insert(0, "step", np.arange(len(found), dtype=np.int64))
        found.insert(0, "block", np.int64(rows["block"].iloc[0]))
        return found

    return first_edges(faces, rule).groupBy("block").applyInPandas(run, "block long, step long, kept long, gone long, score double")


def remaining_graph(faces: DataFrame, threshold: float, name: str, from_greatest: bool = True) -> DataFrame:
    """``block, u, v, score`` of the edges that are left at a threshold."""
    rule = scorer(name, from_greatest)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        merging = Merging(_edges(rows, rule), rule)
        merging.until(threshold)
        found = pd.DataFrame(merging.graph(), columns=["u", "v", "score"]).astype({"u": "int64", "v": "int64", "score": "float64"})
        found.insert(0, "block", np.int64(rows["block"].iloc[0]))
        return found

    return first_edges(faces, rule).groupBy("block").applyInPandas(run, "block long, u long, v long, score double")


def quantile_of_values(rows: DataFrame, keys: list[str], value: str, quantile: int) -> DataFrame:
    """The value at place ``quantile`` percent of each key's ranked values (the last one at most), by ranks within the key."""
    by = Window.partitionBy(*keys)
    ranked = rows.withColumn("r_", F.row_number().over(by.orderBy(value)) - 1).withColumn("n_", F.count("*").over(by))
    return ranked.where(F.col("r_") == F.least(F.expr(f"({quantile} * n_) div 100"), F.col("n_") - 1)).select(*keys, F.col(value).alias("quantile"))


def fragments(rows: DataFrame, affinities: tuple[str, str], spacing: int, grid: Grid | None = None) -> DataFrame:
    """The rows with ``fragment``: each slice of a block flooded from a grid of seeds over one minus the mean affinity in the slice; numbers go on
    from slice to slice."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        mean, place = block_array(block.assign(m_=(block[affinities[0]] + block[affinities[1]]) / 2), "m_", 0.0, grid)
        seeds = np.zeros(mean.shape, np.int64)
        seeds[:, ::spacing, ::spacing] = 1
        seeds[seeds > 0] = np.arange(1, int(seeds.sum()) + 1)
        found = np.stack([flooded(1 - m, s) for m, s in zip(mean, seeds)])
        return block.assign(fragment=found[place])

    fields = ", ".join(f"{c} {k}" for c, k in rows.dtypes)
    return rows.groupBy("block").applyInPandas(run, f"{fields}, fragment long")


def segmented_blocks(rows: DataFrame, affinities: dict[str, str], threshold: float, name: str = "aff50_his256", spacing: int = 4, grid: Grid | None = None) -> DataFrame:
    """``block, z, y, x, id``: every block cut into fragments, which are merged up to ``threshold``: the segmentation stage of a volume.

    ``rows``: ``block, z, y, x`` and an affinity column for each axis. Ids are fragments' numbers, so blocks are put together by the
    overlap merge.
    """
    from stratovox.plans.scratch import saved

    cut = saved(fragments(rows, (affinities["y"], affinities["x"]), spacing, grid), "fragments")
    table = agglomerated(block_faces(cut, "fragment", affinities), [threshold], name).select("block", F.col("id").alias("fragment"), "rep")
    return cut.join(table, ["block", "fragment"], "left").select("block", *AXES, F.coalesce("rep", "fragment").alias("id"))
