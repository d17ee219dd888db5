"""Merging of a whole volume's regions against a plain loop over true scores."""

from __future__ import annotations

import pytest

from stratovox.operators import agglomeration
from tests.test_kernels import plain_score, random_edges


def plain(how, first, threshold):
    """The cheapest pair of regions is looked for again after each merge; scores are always those of all faces."""
    edges, rep = {e: list(a) for e, a in first.items()}, {}
    while edges:
        u, v = min(edges, key=lambda e: (plain_score(how, [edges[e]]), e))
        if plain_score(how, [edges[u, v]]) >= threshold:
            break
        del edges[u, v]
        rep[v] = u
        for e in [e for e in edges if v in e]:
            w = e[0] + e[1] - v
            edges.setdefault((min(u, w), max(u, w)), []).extend(edges.pop(e))
    def find(x):
        return find(rep[x]) if x in rep else x

    return {x: find(x) for x in rep}


def table(spark, first):
    faces = spark.createDataFrame([(v, u, a) for (u, v), part in first.items() for a in part], "u long, v long, aff double")
    return agglomeration.region_edges(faces)


def shifted(seed, by):
    return {(u + by, v + by): a for (u, v), a in random_edges(seed, 40).items()}


@pytest.mark.parametrize("how", ["max", "min", "mean"])
@pytest.mark.parametrize("limit, rounds", [(agglomeration.LIMIT, 24), (60, 24), (60, 0)])
def test_volume_equals_a_plain_loop(spark, how, limit, rounds):
    threshold = {"max": 0.05, "min": 0.7, "mean": 0.42}[how]
    first = {**shifted(1, 0), **shifted(2, 100), (500, 501): [0.99], (501, 502): [0.98], (502, 503): [0.97], (503, 504): [0.96], (504, 505): [0.01]}
    got = {r.id: r.rep for r in agglomeration.agglomerated(table(spark, first), threshold, how, limit, rounds).collect()}
    assert got == plain(how, first, threshold) and len(got) > 10


def test_chains_take_few_rounds(spark):
    """Scores that rise along a chain leave one cheapest pair a round; then earlier thresholds are reached by tasks."""
    first = {(k, k + 1): [1 - k / 1000] for k in range(1, 300)}
    got = {r.id: r.rep for r in agglomeration.agglomerated(table(spark, first), 0.9, "mean", limit=150).collect()}
    assert got == {k: 1 for k in range(2, 301)}


def test_ties_and_empty_tables(spark):
    same = {(u, u + 1): [0.5] for u in range(1, 9)}
    assert {r.id: r.rep for r in agglomeration.agglomerated(table(spark, same), 0.6, "max", limit=2, rounds=0).collect()} == {k: 1 for k in range(2, 10)}
    assert agglomeration.agglomerated(table(spark, same), 0.5, "max").count() == 0
    assert agglomeration.agglomerated(table(spark, same).limit(0), 0.5, "mean").count() == 0
    nulls = spark.createDataFrame([(1, 2, 0.9), (2, 2, 0.9), (None, 2, 0.9), (3, 2, None)], "u long, v long, aff double")
    assert [tuple(r) for r in agglomeration.agglomerated(agglomeration.region_edges(nulls), 0.5, "mean").collect()] == [(2, 1)]


@pytest.mark.parametrize("how, threshold", [("mean", 0.55), ("min", 0.9)])
def test_queries_equal_a_plain_loop(spark, data, how, threshold):
    from stratovox.plans import catalog
    from stratovox.plans.segmentation import _cell_edges

    edges = {(r.u, r.v): r for r in _cell_edges(spark, data).collect()}
    rep = {}
    score = {"mean": lambda e: 1 - e[2] / e[3], "min": lambda e: 1 - e[0]}[how]
    live = {k: (r.low, r.high, r.total, r.faces) for k, r in edges.items()}
    while live:
        u, v = min(live, key=lambda k: (score(live[k]), k))
        if score(live[u, v]) >= threshold:
            break
        del live[u, v]
        rep[v] = u
        for k in [k for k in live if v in k]:
            w, e = k[0] + k[1] - v, live.pop(k)
            new = (min(u, w), max(u, w))
            o = live.get(new, (2.0, -1.0, 0.0, 0))
            live[new] = (min(e[0], o[0]), max(e[1], o[1]), e[2] + o[2], e[3] + o[3])

    def find(x):
        return find(rep[x]) if x in rep else x

    assert {r.id: r.rep for r in catalog.QUERIES[f"agglomerate_volume_{how}"](spark, data).collect()} == {x: find(x) for x in rep}
    assert rep


def test_the_greatest_affinity_needs_no_order_and_nothing_is_broadcast(spark, monkeypatch):
    """Regions below the threshold are components; tables of names, small as their files look, are joined by a shuffle."""
    def never(*_):
        raise AssertionError("merged in order")

    first = shifted(1, 0)
    kept = agglomeration.agglomerated(table(spark, first), 0.42, "mean")
    assert "BroadcastHashJoin" not in agglomeration.relabelled(table(spark, first), kept)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(agglomeration, "_finished", never)
    assert {r.id: r.rep for r in agglomeration.agglomerated(table(spark, first), 0.05, "max").collect()} == plain("max", first, 0.05)


def test_many_small_components_go_to_few_tasks(spark):
    """Components are dealt whole; a Python call gets many of them, and each is merged as by itself."""
    first = {e: [a] for k in range(0, 9000, 3) for e, a in (((k + 1, k + 2), 0.9 - k % 7 / 100), ((k + 2, k + 3), 0.8), ((k + 1, k + 3), 0.1))}
    edges = table(spark, first)
    dealt = agglomeration.shared(agglomeration._by_component(edges, edges.where("1 - total / faces < 0.5")), 1000)
    found = dealt.groupBy("component").agg({"share": "min", "component": "count"}).collect()
    assert len(found) == 3000 and all(r["count(component)"] == 3 for r in found) and dealt.select("share").distinct().count() <= 9
    got = {r.id: r.rep for r in agglomeration.agglomerated(edges, 0.5, "mean").collect()}
    assert got == {k: k - 1 for k in range(2, 9001, 3)}


def test_edges_that_are_not_open_count_in_a_component(spark, monkeypatch):
    """Few open edges may hold a component of many edges; an earlier threshold bounds what one task gets."""
    first = {(u, v): [1 - (u + v) / 1000 if v == u + 1 else 0.1] for u in range(1, 41) for v in range(u + 1, 41)}
    most, run = [], agglomeration._finished

    def finished(inside, how, threshold):
        most.append(inside.groupBy("component").count().agg({"count": "max"}).first()[0])
        return run(inside, how, threshold)

    monkeypatch.setattr(agglomeration, "_finished", finished)
    got = {r.id: r.rep for r in agglomeration.agglomerated(table(spark, first), 0.3, "mean", limit=60).collect()}
    assert got == plain("mean", first, 0.3) and got and max(most) <= 60
