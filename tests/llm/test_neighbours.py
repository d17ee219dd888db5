"""NN-descent links against all pairs, and the defined cases."""

from __future__ import annotations

import numpy as np
import pytest

from stratovox.llm import neighbours


def brute(rows, threshold=0.98):
    parent, degree = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = []
    for i, v, label in rows:
        parent[i], degree[i] = i, 0
        if v and label is not None and None not in v and np.isfinite(v).all() and any(v):
            v = np.array(v, float)
            good.append((i, v / np.linalg.norm(v), label))
    for a, (i, v, k) in enumerate(good):
        for j, w, m in good[a + 1 :]:
            if k == m and len(v) == len(w) and v @ w >= threshold:
                degree[i] += 1
                degree[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (degree[i], find(i)) for i in parent}


@pytest.mark.parametrize("chunk", [1024, 16])
def test_links_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    r = np.random.default_rng(3)
    rows = []
    for label in (1, 2, None):
        centres = r.standard_normal((40, 16))
        points = np.concatenate([centres, centres[:10] + 0.04 * r.standard_normal((10, 16)), centres[0] + 0.03 * r.standard_normal((60, 16))])
        rows += [(len(rows) + i, p.astype(np.float32).tolist(), label) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]
    frame = spark.createDataFrame([(*x, 5, "c") for x in rows], "vec_id long, embedding array<float>, label int, id long, vec string")
    found, recall = neighbours.near_duplicates(frame)
    assert recall >= 0.99
    assert {x.id: (x.n_links, x.component) for x in found.collect()} == brute(rows)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [1e300, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found, _ = neighbours.near_duplicates(frame)
    got = {r.id: (r.n_links, r.component) for r in found.collect()}
    assert got == {i: (1, 8) if i in (8, 9) else (0, i) for i, *_ in rows}
    repeated, _ = neighbours.near_duplicates(frame.where("vec_id = 8").union(frame.where("vec_id = 8")))
    assert [(r.n_links, r.component) for r in repeated.collect()] == [(1, 8), (1, 8)]
    nothing, _ = neighbours.near_duplicates(frame.limit(0))
    assert nothing.count() == 0


def test_query_equals_sql(spark, data):
    from stratovox.llm import queries
    from tests.compare import same

    same(queries.op7_neighbours(spark, data), queries.ORACLE_SQL["op7_neighbours"], data)
