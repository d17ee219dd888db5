"""Connected components of an edge table: by contraction where nodes are whole numbers, else by alternating large-star and small-star steps.

Contraction deals the edges to tasks by ranges of their ends and replaces the edges of each share by its spanning stars. Only nodes that lie in several
shares link the shares' roots, so edges among near nodes (voxels of a volume) leave a small table, which is treated in the same way; once it fits one
share the result is there. Where a contraction leaves over half of the edges (nodes without any order) stars take over.

Every star step is a partial aggregation and a join of the edges with one minimum for each node. The minima of hubs (nodes
with over one in ``HUBS`` of the edges, so fewer than ``HUBS`` rows at any size) are broadcast, the others are joined by a
shuffle, so that no task gets a star's whole set of leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.plans.scratch import discard, saved

HUBS = 1000
#: Edges of a task, so that rounds over few edges don't pay for many empty tasks.
EDGES = 250_000


def _least(edges: DataFrame, low: F.Column) -> DataFrame:
    """``u, m, n``: the least of ``low`` over the edges of each node ``u``, and how many it has."""
    return edges.groupBy("u").agg(F.min(low).alias("m"), F.count("*").alias("n"))


def _tasks(edges: DataFrame, rows: int) -> int:
    return max(edges.sparkSession.sparkContext.defaultParallelism, -(-rows // EDGES))


def _joined(edges: DataFrame, least: DataFrame, rows: int) -> DataFrame:
    """``u, v, m``: every edge with its node's minimum; ``rows``: the number of edges, or more."""
    hubs = F.broadcast(least.where(F.col("n") * HUBS > rows).select("u", "m").coalesce(_tasks(edges, rows)))
    # by a shuffle: minima that compress well look small, but not in the memory of a driver that would broadcast them
    few = least.where(F.col("n") * HUBS <= rows).select("u", "m").hint("merge")
    return edges.join(hubs, "u").unionByName(edges.join(hubs, "u", "left_anti").join(few, "u"))


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _joined(both, _least(both, F.least("u", "v")), 2 * rows)
    return found.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every edge leads from its greater end (``u``) to a lesser one."""
    least = _least(edges, F.col("v"))
    moved = _joined(edges, least, rows).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether every node has one lesser neighbour, which has none itself: then that is the least of the component."""
    ends = edges.select("u", F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    found = nodes.coalesce(_tasks(edges, 0)).agg(F.sum("down").alias("n"), F.max("down").alias("most"), F.max(F.when(F.col("down") > 0, F.col("up"))).alias("path")).first()
    return found["n"] or 0, not found["n"] or (found["most"] == 1 and not found["path"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges ``a, b`` in order, and the least node of the component of each."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[root]


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, root`` of the edges of a task, in portions of bounded size."""
    held: list[pa.RecordBatch] = []

    def out():
        ends = [np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in forest(*ends)], names=["node", "root"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) > 4 * EDGES:
            yield from out()
            held = []
    if held:
        yield from out()


def grouped(stars: DataFrame, node: str, root: str) -> DataFrame:
    """``node, least, roots`` of every node: the least of its roots, and all of them."""
    return stars.groupBy(F.col(node).alias("node")).agg(F.min(root).alias("least"), F.collect_set(root).alias("roots"))


def linked(groups: DataFrame) -> DataFrame:
    """``u, v``: of every node that has several roots each root but the least, and the least; the edges that are left between roots."""
    return groups.where(F.size("roots") > 1).select(F.explode("roots").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()


def named(rows: DataFrame, key: str, roots: DataFrame) -> DataFrame:
    """``rows`` with ``root``: of ``key`` by ``roots`` (``node, root``), itself where it isn't there. A small table is broadcast, a larger one never."""
    small = roots.limit(EDGES + 1).count() <= EDGES
    table = roots.withColumnRenamed("node", key)
    found = rows.join(F.broadcast(table) if small else table.hint("merge"), key, "left")
    return found.withColumn("root", F.coalesce("root", key))


def _contracted(current: DataFrame, max_rounds: int) -> DataFrame:
    """As :func:`components`, of saved ``u, v`` of longs."""
    n = current.count()
    shares = -(-n // EDGES)
    dealt = current.coalesce(1) if shares <= 1 else current.repartitionByRange(shares, "u", "v")
    stars = saved(dealt.mapInArrow(_stars, "node long, root long"), "stars")
    discard(current)
    if shares <= 1:
        return stars.where("node <> root")
    groups = saved(grouped(stars, "node", "root"), "nodes")
    discard(stars)
    left = saved(linked(groups), "edges")
    m = left.count()
    found = saved(_contracted(left, max_rounds) if 2 * m <= n else _starred(left, max_rounds), "roots")
    return named(groups.select("node", "least"), "least", found).select("node", "root").where("node <> root")


def _starred(current: DataFrame, max_rounds: int) -> DataFrame:
    """As :func:`components`, of saved ``u, v`` without repetitions, ``v`` below ``u``."""
    for _ in range(max_rounds):
        n, settled = _state(current)
        if settled:
            break
        star = saved(_large_star(current, n).coalesce(_tasks(current, n)), "edges")
        discard(current)
        current = saved(_small_star(star, n).distinct().coalesce(_tasks(star, n)), "edges")
        discard(star)
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node that has an edge to another; ``root`` is its component's least node.

    ``edges``: two columns of one orderable type. Self-loops, repeated edges, both directions and rows
    with a null end are allowed; loops and nulls are dropped. An empty table gives an empty table.
    Each round is written to the shared folder, so the plan never grows; rounds grow with the logarithm
    of the longest path.
    """
    ends = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    kind = dict(ends.dtypes)["u"]
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        return _starred(saved(ends.distinct(), "edges"), max_rounds)
    found = _contracted(saved(ends.select(*(F.col(c).cast("long").alias(c) for c in "uv")), "edges"), max_rounds)
    return saved(found.select(*(F.col(c).cast(kind).alias(c) for c in ("node", "root"))), "components")
