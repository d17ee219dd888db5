"""Merging of a whole volume's regions, for scores that no merge can bring below both of the edges it joins.

That holds for one minus the greatest, the least and the mean affinity (single, complete and average linkage). For such scores

- an edge that is the cheapest of both its regions will be merged before anything that touches them, whatever happens elsewhere, so
  all such edges can be merged at once;
- regions only ever merge inside a connected component of the edges below the threshold.

For the greatest affinity these components are the result. Else the edge table goes through rounds of the first kind while it is large, and once its components below the threshold are
small each is finished by one task, cheapest edge first, many small ones by the same. If rounds bring little or a component stays too large, an earlier
threshold is reached first, below which components are small enough. Edges carry statistics that merge (least, greatest, sum and number of
faces), and every step is written to the shared folder.

Defined cases: regions of no edge below the threshold aren't returned; repeated edges are summed up, loops and rows with nulls dropped; an empty
table gives an empty table. Among edges of one score the lesser regions come first, within each step; different orders of ties can give
different partitions, except for the greatest affinity.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratovox.operators.components import components
from stratovox.operators.merging import Merging, Statistics, scorer
from stratovox.operators.watershed import SIDE, basin_parts, named_parts
from stratovox.plans.scratch import saved

#: Edges of a component that one task may hold, and edges of small components that go to one task together.
LIMIT, SHARE = 200_000, 10_000
#: Rounds of cheapest edges before an earlier threshold is taken, and the share of the open edges that a round has to remove.
ROUNDS = 24
WORTH = 0.02

SCORES = {"max": lambda: 1 - F.col("high"), "min": lambda: 1 - F.col("low"), "mean": lambda: 1 - F.col("total") / F.col("faces")}


def region_edges(touching: DataFrame) -> DataFrame:
    """``u, v, low, high, total, faces`` of each two touching regions, from ``u, v, aff``."""
    kept = touching.where(F.col("u") != F.col("v")).where(F.col("aff").isNotNull())
    ends = kept.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), F.col("aff").cast("double").alias("aff"))
    return ends.groupBy("u", "v").agg(F.min("aff").alias("low"), F.max("aff").alias("high"), F.sum("aff").alias("total"), F.count("*").alias("faces"))


def _summed(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u", "v").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("faces").alias("faces"))


def relabelled(edges: DataFrame, merges: DataFrame) -> DataFrame:
    """The edges between what ``merges`` (``id, rep``) makes of the regions; edges that become parallel are summed up."""
    found = edges
    for end in ("u", "v"):
        named = merges.select(F.col("id").alias(end), F.col("rep").alias(f"{end}_"))
        # by a shuffle, as all tables here that grow with the volume: whole numbers compress well, so their files look small to the planner
        found = found.join(named.hint("merge"), end, "left").withColumn(end, F.coalesce(f"{end}_", end)).drop(f"{end}_")
    found = found.where(F.col("u") != F.col("v"))
    return _summed(found.withColumns({"u": F.least("u", "v"), "v": F.greatest("u", "v")}))


def reciprocal(edges: DataFrame, score: Column, threshold: float) -> DataFrame:
    """``id, rep`` of the regions that are each other's cheapest, below the threshold; the lesser id stays."""
    open_ = edges.where(score < threshold).select("u", "v", score.alias("s"))
    ends = open_.select(F.explode(F.array("u", "v")).alias("own"), F.struct("s", "u", "v").alias("edge"))
    best = ends.groupBy("own").agg(F.min("edge").alias("edge"))
    return best.groupBy(F.col("edge.u").alias("rep"), F.col("edge.v").alias("id")).agg(F.count("*").alias("n")).where("n = 2").select("id", "rep")


def _composed(done: DataFrame, step: DataFrame) -> DataFrame:
    """The regions' names after ``done`` and then ``step``."""
    named = step.select(F.col("id").alias("rep"), F.col("rep").alias("new_"))
    return done.join(named.hint("merge"), "rep", "left").select("id", F.coalesce("new_", "rep").alias("rep")).unionByName(step)


def _by_component(edges: DataFrame, open_: DataFrame) -> DataFrame:
    """The edges whose regions both lie in one component of the open edges, with its name."""
    found = components(open_, "u", "v")
    roots, inside = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()), edges
    for end in ("u", "v"):
        inside = inside.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_")).hint("merge"), end)
    return inside.where("u_ = v_").withColumnRenamed("u_", "component").drop("v_")


def shared(inside: DataFrame, edges: int) -> DataFrame:
    """``inside`` with ``share``: whole components, dealt to shares of about ``edges`` edges (a larger component makes its share larger), a task a share."""
    shares = max(1, -(-inside.count() // edges))
    return inside.withColumn("share", F.pmod(F.xxhash64("component"), F.lit(shares))).repartition(shares, "share")


def _finished(inside: DataFrame, how: str, threshold: float) -> DataFrame:
    """``id, rep`` of all merges of each component, cheapest edge first. Most components have a few edges, so a Python call gets a share of them:
    what lies in different components never meets, so each is merged as it would be by itself."""
    rule = scorer(how)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = {(int(r.u), int(r.v)): Statistics(r.low, r.high, r.total, int(r.faces), 0, [], []) for r in rows.itertuples(index=False)}
        merging = Merging(found, rule)
        merging.until(threshold)
        return pd.DataFrame([(r, merging.find(r)) for r in merging.rep], columns=["id", "rep"]).astype({"id": "int64", "rep": "int64"})

    return shared(inside, SHARE).groupBy("share").applyInPandas(run, "id long, rep long")


def _earlier(open_: DataFrame, score: Column, share: float, threshold: float) -> float:
    """A threshold below which about a ``share`` of the open edges lies, those of the least score at least."""
    found = open_.agg(F.percentile_approx(score, share, 10_000)).first()[0]
    return min(math.nextafter(found, math.inf), threshold)


def _bounded(edges: DataFrame, open_: DataFrame, n: int, score: Column, threshold: float, limit: int) -> tuple[DataFrame, float]:
    """The edges inside of components below a threshold, and that threshold: the given one, or the earlier one that halving the ``n`` open edges first comes to
    at which no component has over ``limit`` edges. Edges between a component's regions count too, however few of them are open."""
    inside, share = saved(_by_component(edges, open_), "inside"), 1.0
    while share * n >= 1 and (inside.groupBy("component").count().agg(F.max("count")).first()[0] or 0) > limit:
        share /= 2
        if (earlier := _earlier(open_, score, share, threshold)) < threshold:
            threshold = earlier
            inside = saved(_by_component(edges, edges.where(score < threshold)), "inside")
    return inside, threshold


def agglomerated(edges: DataFrame, threshold: float, how: str = "mean", limit: int = LIMIT, rounds: int = ROUNDS) -> DataFrame:
    """``id, rep`` of every region that is merged into another by merging the cheapest edge below ``threshold`` again and again.

    ``edges``: :func:`region_edges`, ids as longs. ``how``: ``max``, ``min`` or ``mean``, the statistic that is subtracted from one.
    A region is named by the least id it holds.
    """
    score = SCORES[how]()
    if how == "max":  # no merge changes whether an edge is below the threshold, so their order doesn't matter
        found = components(edges.where("u < v").where(score < threshold), "u", "v")
        return found.select(F.col("node").alias("id"), F.col("root").alias("rep"))
    edges = saved(_summed(edges.where("u is not null and v is not null and u < v")), "edges")
    done, left, before = edges.select(F.col("v").alias("id"), F.col("u").alias("rep")).limit(0), rounds, None
    while n := (open_ := edges.where(score < threshold)).count():
        upto = None
        if n > limit and left and (before is None or n <= (1 - WORTH) * before):
            step, left, before = saved(reciprocal(edges, score, threshold), "merges"), left - 1, n
        else:
            before = None
            inside, upto = _bounded(edges, open_, n, score, threshold, limit)
            step = saved(_finished(inside, how, upto), "merges")
            if upto == threshold:
                return _composed(done, step)
        done, edges = saved(_composed(done, step), "names"), saved(relabelled(edges, step), "edges")
    return done


def segmented_volume(volume: DataFrame, affinities: dict[str, str], threshold: float, how: str = "mean", low: float = 0.0, high: float = 1.0, size: tuple[int, int] | None = None,
                     side: int = SIDE) -> DataFrame:
    """``z, y, x, id``: the whole volume cut into basins of its affinities, which are merged up to ``threshold``; 0 where no affinity is above ``low``.

    Ids are the least linear index (plus 1) of a basin that the region holds; nothing is cut at borders of blocks. Blocks of the watershed tell which parts of
    basins touch, so only their edges, not the voxels, are shuffled for the merging, and voxels are named once at the end.
    """
    parts, roots, touching = basin_parts(volume, affinities, low, high, size, side, edges=True)
    basins = roots.select(F.col("node").alias("id"), F.col("root").alias("rep"))
    merges = agglomerated(saved(relabelled(touching, basins), "edges"), threshold, how)
    names = saved(_composed(basins, merges).select(F.col("id").alias("node"), F.col("rep").alias("root")), "names")
    return named_parts(parts, names)
