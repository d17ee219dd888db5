"""Bit-sliced search against plain inner products, and the defined cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from stratovox.llm import queries, vector_search
from tests.compare import same

ROWS = "vec_id long, embedding array<double>, label int, score string, q string"


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i is None or i % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for j, w in good if j != i and len(v) == len(w))[:k]
        out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(found)]
    return sorted(out, key=repr)


def table(seed, n=400, size=12):
    r = np.random.default_rng(seed)
    v = r.normal(0, 0.4, (n, size))
    v[100:220] = v[100]  # ties at the boundary
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(None, v[5].tolist()), (None, v[5].tolist()), (600, None), (650, [None] * size), (700, [float("nan")] * size), (750, [float("inf")] + [0.1] * (size - 1))]
    return rows + [(800, [0.0] * size), (850, v[3].tolist()[:4]), (851, [1.0, -2.0, 0.5, 0.25]), (900, []), (901, []), (50, v[7].tolist()), (950, [-3.5] * size), (951, [1000.25] * size)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", "q") for i, v in rows], ROWS)


def run(spark, rows, k=5, **options):
    d = frame(spark, rows)
    found = vector_search.search(vector_search.build(d, block=options.pop("block", vector_search.BLOCK)), d.where("vec_id % 50 = 0"), k=k, **options)
    return sorted([(r["query"], r["rank"], r["id"], r["score"]) for r in found.collect()], key=repr)


@pytest.mark.parametrize("k, options", [(5, {}), (1, {"block": 64}), (150, {"block": 100}), (5, {"query_bytes": 300})])
def test_ranks_equal_plain_products(spark, k, options):
    rows = table(1)
    assert run(spark, rows, k, **options) == brute(rows, k)


def test_empty_tables(spark):
    d = frame(spark, table(2, 150))
    assert vector_search.search(vector_search.build(d.limit(0)), d.where("vec_id % 50 = 0")).count() == 0
    assert vector_search.search(vector_search.build(d), d.limit(0)).count() == 0
    assert run(spark, [(0, [0.5, 0.25])]) == []


def test_blocks_of_equal_vectors_and_zero_queries(spark):
    rows = [(i, [0.5, -0.25]) for i in range(120)] + [(200, [0.0, 0.0])]
    assert run(spark, rows[:120]) == brute(rows[:120])
    assert run(spark, rows, block=16) == brute(rows)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(0, [1e9]), (1, [0.1])])


def test_slices_add_up():
    r = np.random.default_rng(3)
    v = r.integers(-300, 300, (333, 9))
    block = vector_search.Slices.of(np.arange(333), np.zeros(333, bool), v)
    query = r.integers(-40, 40, 9)
    sums, constant = block.scores(query)
    total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:333].astype(np.int64) << k for k, s in enumerate(sums)), np.zeros(333, np.int64))
    assert (total + constant == v @ query).all()


def test_query_equals_sql(spark, data):
    same(queries.QUERIES["op13_vector_search"](spark, data), queries.ORACLE_SQL["op13_vector_search"], data)
