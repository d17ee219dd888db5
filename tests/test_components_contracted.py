"""Contraction of edges and of blocks against a plain union of sets."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratovox.operators import components as module
from stratovox.operators import decoders, labels
from stratovox.operators.targets import half_ball


def united(edges):
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in root if find(k) != k}


def random_edges(kind):
    r = np.random.default_rng(3)
    if kind == "line":
        return [(k, k + 1) for k in range(400) if k % 37]
    if kind == "shuffled line":
        names = r.permutation(400)
        return [(int(names[k]), int(names[k + 1])) for k in range(399) if k % 37]
    if kind == "star":
        return [(-5, k) for k in range(300)] + [(500, k) for k in range(301, 400)]
    return [tuple(map(int, e)) for e in r.integers(0, 500, (420, 2))]


@pytest.mark.parametrize("kind", ["line", "shuffled line", "star", "random"])
def test_contraction_by_shares_equals_union(spark, monkeypatch, kind):
    monkeypatch.setattr(module, "EDGES", 40)
    edges = random_edges(kind)
    found = module.components(spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long"))
    rows = found.collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.root for r in rows} == united(edges)


def test_small_graph_takes_no_rounds_of_stars(spark, monkeypatch):
    """A path of few edges took a round for every doubling, each of several jobs; it is one task's now."""
    monkeypatch.setattr(module, "_starred", lambda *a: pytest.fail("stars"))
    found = module.components(spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    assert found.count() == 300 and found.agg(F.max("root")).first()[0] == 0


@pytest.mark.parametrize("corners", [False, True])
def test_components_across_blocks_equal_union(spark, monkeypatch, corners):
    monkeypatch.setattr(labels, "SIDE", 3)
    r = np.random.default_rng(5)
    value = r.integers(0, 3, (7, 8, 10)) * (r.random((7, 8, 10)) < (0.5 if corners else 0.8))
    index = lambda p: (p[0] * 8 + p[1]) * 10 + p[2] + 1
    offsets = half_ball(1.8) if corners else [(-1, 0, 0), (0, -1, 0), (0, 0, -1)]
    edges = []
    for p in product(*map(range, value.shape)):
        for o in offsets:
            q = tuple(a + b for a, b in zip(p, o))
            if all(0 <= k < n for k, n in zip(q, value.shape)) and value[p] and value[p] == value[q]:
                edges.append((index(p), index(q)))
    roots = united(edges)
    rows = [(*p, int(value[p])) for p in product(*map(range, value.shape))]
    volume = spark.createDataFrame(rows, "z int, y int, x int, l int")
    found = decoders.fully_connected(volume, "l", (8, 10)) if corners else labels.grid_components(volume, "l", (8, 10))
    got = {(r.z, r.y, r.x): r.component for r in found.collect()}
    want = {p: roots.get(index(p), index(p)) if value[p] else 0 for p in product(*map(range, value.shape)) if value[p] or not corners}
    assert got == want


def test_small_table_of_roots_only_is_broadcast(spark, monkeypatch):
    """Names of nodes compress so well that the planner took them for small and sent millions of them through the driver."""
    monkeypatch.setattr(module, "EDGES", 40)
    rows, roots = spark.range(100).withColumnRenamed("id", "k"), spark.range(1, 90).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("root"))
    plan = module.named(rows, "k", roots)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
