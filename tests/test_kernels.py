"""Order-dependent steps on blocks, and all queries without SQL, against plain loops."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratovox.operators import decoders, kernels, merging, targets
from stratovox.plans import catalog
from tests.test_operators import as_dict, volume


def plain_score(name, first):
    """The score of an edge from the affinities of each first edge it is made of."""
    every, greatest = sorted(a for part in first for a in part), sorted(max(part) for part in first)
    if name in ("min", "max", "mean", "contact"):
        return {"min": 1 - every[0], "max": 1 - every[-1], "mean": 1 - sum(every) / len(every), "contact": 1 / len(every)}[name]
    if name.startswith("max"):
        best = every[-int(name[3:]) :]
        return 1 - sum(best) / len(best)
    quantile, bins = (int(x) for x in name.replace("aff", "").replace("_his", " ").split()) if "his" in name else (int(name[3:]), 0)
    at = greatest[min(quantile * len(greatest) // 100, len(greatest) - 1)]
    return 1 - ((min(int(at * bins), bins - 1) + 0.5) / bins if bins else at)


def plain_merging(name, first, thresholds):
    """All live edges are scanned for the least stored score; of two parallel edges the cheaper one lives on, with the score that was stored for it,
    which is made true when it comes up. Regions, history and live edges after each threshold."""
    edges = [{"ends": set(ends), "first": [part], "stored": plain_score(name, [part]), "true": True} for ends, part in sorted(first.items())]
    merged, history, out = {}, [], []
    for t in thresholds:
        while edges and min(e["stored"] for e in edges) < t:
            e = min(edges, key=lambda x: x["stored"])
            if not e["true"]:
                e["stored"], e["true"] = plain_score(name, e["first"]), True
                continue
            u, v = sorted(e["ends"])
            history.append((u, v, e["stored"]))
            merged[v] = u
            edges.remove(e)
            for other in [x for x in edges if v in x["ends"]]:
                ends = other["ends"] - {v} | {u}
                twin = next((x for x in edges if x["ends"] == ends), None)
                other["ends"] = ends
                if twin:
                    cheap, dear = (twin, other) if other["stored"] > twin["stored"] else (other, twin)
                    cheap["first"] += dear["first"]
                    cheap["true"] = False
                    edges.remove(dear)
        true = [(*sorted(e["ends"]), plain_score(name, e["first"])) for e in edges]
        out.append((dict(merged), list(history), sorted(x for x in true if x[2] >= t)))
    return out


def root(rep, x):
    while x in rep:
        x = rep[x]
    return x


NAMES = ["min", "max", "mean", "max3", "max10", "aff50_his256", "aff85_his0", "aff50"]


def random_edges(seed, regions=14, distinct=True):
    """Affinities of each first edge; as multiples of 2**-20, sums are exact, and all are distinct."""
    r = random.Random(seed)
    pool = iter(r.sample(range(1 << 20), 4000))
    return {(u, v): [next(pool) / (1 << 20) for _ in range(r.randrange(1, 7))] for u in range(1, regions) for v in range(u + 1, regions) if r.random() < 0.45}


@pytest.mark.parametrize("name", NAMES)
def test_merging_equals_a_plain_loop(name):
    for seed in range(60):
        first, rule, thresholds = random_edges(seed), merging.scorer(name), [0.2, 0.4, 0.6, 0.8]
        run = merging.Merging({e: merging.first_statistics(a, rule) for e, a in first.items()}, rule)
        for t, (merged, history, live) in zip(thresholds, plain_merging(name, first, thresholds)):
            run.until(t)
            assert {x: run.find(x) for x in run.rep} == {x: root(merged, x) for x in merged}
            assert [h[:2] for h in run.history] == [h[:2] for h in history] and [h[2] for h in run.history] == pytest.approx([h[2] for h in history])
            assert [e[:2] for e in run.graph()] == [e[:2] for e in live] and [e[2] for e in run.graph()] == pytest.approx([e[2] for e in live])


def test_the_dearer_edge_goes_into_the_cheaper_one():
    """The survivor holds the dearer one of two edges that become parallel."""
    rule = merging.scorer("max")
    run = merging.Merging({e: merging.first_statistics([a], rule) for e, a in {(1, 2): 0.95, (1, 3): 0.2, (2, 3): 0.9}.items()}, rule)
    run.until(0.5)
    assert {x: run.find(x) for x in (1, 2, 3)} == {1: 1, 2: 1, 3: 1} and run.graph() == []


def test_histograms_of_all_faces():
    rule = merging.scorer("aff50_his10", from_greatest=False)
    assert rule.score(merging.first_statistics([0.11, 0.12, 0.13, 0.95], rule)) == pytest.approx(1 - 0.15)
    assert merging.scorer("aff50_his10").score(merging.first_statistics([0.11, 0.12, 0.13, 0.95], merging.scorer("aff50_his10"))) == pytest.approx(1 - 0.95)


@pytest.mark.parametrize("name, from_greatest", [("max", True), ("max3", True), ("aff50_his16", True), ("aff50_his16", False), ("mean", True)])
def test_edges_of_blocks_are_summed_up_before_they_are_merged(spark, name, from_greatest):
    rule = merging.scorer(name, from_greatest)
    rows = [(b, u, v, a) for b in (3, 4) for (u, v), part in random_edges(b).items() for a in part]
    faces = spark.createDataFrame(rows, "block long, u long, v long, aff double")
    got = {b: {} for b in (3, 4)}
    for r in merging.agglomerated(faces, [0.45], name, from_greatest).collect():
        got[r.block][r.id] = r.rep
    for b in (3, 4):
        run = merging.Merging({e: merging.first_statistics(a, rule) for e, a in random_edges(b).items()}, rule)
        run.until(0.45)
        assert got[b] == {x: run.find(x) for x in run.rep}
    left = merging.remaining_graph(faces, 0.45, name, from_greatest).where("block = 4").orderBy("u", "v").collect()
    assert [(r.u, r.v) for r in left] == [(u, v) for u, v, _ in run.graph()]
    assert merging.merge_history(faces, 0.45, name, from_greatest).where("block = 4").count() == len(run.history)


def test_short_names():
    edge = merging.first_statistics([0.1, 0.5, 0.9], merging.scorer("max2"))
    assert merging.scorer("max2").score(edge) == pytest.approx(0.3)
    assert merging.scorer("aff50").score(edge) == pytest.approx(0.1)
    with pytest.raises(ValueError):
        merging.scorer("his50")


def plain_flood(height, seeds):
    """Every cell takes the seed that reaches it over the lowest path: relaxation until nothing changes."""
    best = {p: (float(height[p]), 0) for p in zip(*np.nonzero(seeds))}
    level = np.full(height.shape, np.inf)
    for p in best:
        level[p] = height[p]
    changed = True
    while changed:
        changed = False
        for p in np.ndindex(height.shape):
            for axis in range(height.ndim):
                for d in (-1, 1):
                    q = (*p[:axis], p[axis] + d, *p[axis + 1 :])
                    if 0 <= q[axis] < height.shape[axis] and max(level[q], height[p]) < level[p]:
                        level[p], changed = max(level[q], height[p]), True
    return level


def test_flooding_follows_the_lowest_paths():
    r = np.random.default_rng(2)
    height = r.random((9, 11))
    seeds = np.zeros(height.shape, np.int64)
    seeds[::4, ::5] = np.arange(1, 10).reshape(3, 3)
    found = kernels.flooded(height, seeds)
    assert (found > 0).all() and (found[seeds > 0] == seeds[seeds > 0]).all()
    level = plain_flood(height, seeds)
    for seed in range(1, 10):  # within the area of a seed its own lowest path is as low as any
        own = plain_flood(np.where(found == seed, height, np.inf), np.where(seeds == seed, seeds, 0))
        assert np.allclose(own[found == seed], level[found == seed])


def test_seeded_instances_stay_in_the_mask(spark):
    r = random.Random(3)
    rows = [(0, 0, y, x, round(r.random(), 3)) for y in range(12) for x in range(12)]
    frame = spark.createDataFrame(rows, "block long, z int, y int, x int, p double")
    got = as_dict(decoders.watershed_instances(frame, "p", None, 0.8, 0.4, 0.0, 1), "id")
    p = {(z, y, x): v for _, z, y, x, v in rows}
    mask = np.array([[p[0, y, x] > 0.4 for x in range(12)] for y in range(12)])
    parts = decoders.numbered(mask)
    seeded = {parts[y, x] for (_, y, x), v in p.items() if v > 0.8}
    for (z, y, x), found in got.items():
        assert (found > 0) == bool(mask[y, x] and parts[y, x] in seeded)


def test_split_covers_the_object(spark):
    shape = ["1111....", "1111....", "1111111.", "1111.111", ".....111"]
    rows = [(0, 0, y, x, 7 if c == "1" else 2) for y, line in enumerate(shape) for x, c in enumerate(line)]
    frame = spark.createDataFrame(rows, "block long, z int, y int, x int, l long")
    got = as_dict(decoders.split_object(frame, "l", 7, (1.0, 1.0, 1.0), 50), "l")
    inside = {(z, y, x) for _, z, y, x, v in rows if v == 7}
    assert {k for k, v in got.items() if v != 2} == inside
    assert {v for k, v in got.items() if k in inside} >= {7} and got[0, 0, 0] != got[0, 4, 7]
    for label in set(got.values()) - {2}:
        assert decoders.numbered(np.array([[got.get((0, y, x)) == label for x in range(8)] for y in range(5)])).max() == 1


def test_split_objects_of_blocks_get_ids_of_their_own(spark):
    """Two blocks of which each is cut in two, one without rows for its background, and one that lacks the object."""
    bars = [(b, 0, y, x + 8 * b, 7) for b in range(2) for y in range(5) for x in range(7) if y != 2 or x == 3] + [(2, 0, 0, 16, 5)]
    frame = spark.createDataFrame(bars, "block long, z int, y int, x int, l long")
    found = decoders.split_object(frame, "l", 7, (1.0, 1.0, 1.0), 50, kernels.Grid((1, 5, 8), (1, 5, 24))).collect()
    ids = [{r.l for r in found if r.block == b} - {7} for b in range(2)]
    assert len(found) == len(bars) and ids[0] and ids[1] and not ids[0] & ids[1]
    assert sorted(ids[0] | ids[1]) == list(range(50, 50 + len(ids[0] | ids[1]))) and {r.l for r in found if r.block == 2} == {5}


def test_blocks_with_missing_background(spark):
    """A bar whose background has no rows; the grid tells where the block ends."""
    frame = spark.createDataFrame([(0, 0, 2, x, 1) for x in range(6)], "block long, z int, y int, x int, m int")
    grid = kernels.Grid((1, 4, 6), (1, 4, 6))
    assert {r.distance for r in kernels.distance_blocks(frame, "m", (1.0, 1.0, 1.0), grid).collect()} == {1.0}
    assert {r.distance for r in kernels.distance_blocks(frame, "m", (1.0, 1.0, 1.0)).collect()} == {-1.0}


def test_contours_keep_seeds_apart(spark):
    score = [0.9, 0.9, 0.8, 0.9, 0.9]
    rows = [(0, 0, 0, x, s, 0.9 if x == 2 else 0.1) for x, s in enumerate(score)]
    frame = spark.createDataFrame(rows, "block long, z int, y int, x int, p double, c double")
    one = as_dict(decoders.watershed_instances(frame, "p", None, 0.7, 0.5, 0.0, 1), "id")
    two = as_dict(decoders.watershed_instances(frame, "p", "c", 0.7, 0.5, 0.5, 1), "id")
    assert [one[0, 0, x] for x in range(5)] == [1] * 5
    assert [two[0, 0, x] for x in (0, 1, 3, 4)] == [1, 1, 2, 2] and two[0, 0, 2] in (1, 2)


def test_flooding_takes_seeds_of_extrema(spark):
    from stratovox.operators import seeds

    height = [3.0, 1.0, 2.0, 5.0, 4.0, 0.0, 0.0, 6.0]
    frame = spark.createDataFrame([(0, 0, 0, x, h) for x, h in enumerate(height)], "block long, z int, y int, x int, h double")
    found = frame.join(seeds.regional_extrema(frame, "h"), ["z", "y", "x"], "left")
    got = as_dict(kernels.flooded_blocks(found, "h", "seed"), "id")
    assert [got[0, 0, x] for x in range(8)] == [2, 2, 2, got[0, 0, 3], 6, 6, 6, 6] and got[0, 0, 3] in (2, 6)


def test_means_count_missing_voxels(spark):
    from pyspark.sql import functions as F

    from stratovox.operators import augment, volumes

    frame = spark.createDataFrame([(0, 0, 0, 1.0), (0, 1, 4, 1.0), (0, 0, 2, 1.0)], "z int, y int, x int, v double")
    got = as_dict(volumes.downsampled_mean(frame, "v", (2, 2, 2)), "v")
    assert got == {(0, 0, 0): 0.25, (0, 0, 1): 0.25, (0, 0, 2): 0.5}
    assert as_dict(volumes.downsampled_mean(frame, "v", (2, 2, 2), (2, 2, 6)), "v")[0, 0, 2] == 0.125
    assert as_dict(augment.filled_with_mean(frame, "v", F.col("x") == 1), "v")[0, 0, 1] == pytest.approx(0.3)
    assert as_dict(augment.blurred_slices(frame, "v", F.lit(True)), "v")[0, 0, 1] == pytest.approx((2 / 3 + 0) / 2)


def test_small_parts_of_slices(spark):
    r = random.Random(4)
    values = [[[r.choice([0, 1, 1, 2]) for _ in range(5)] for _ in range(4)] for _ in range(3)]
    got = as_dict(decoders.small_in_slices(volume(spark, values), "v", 4), "small")
    a = np.array(values)
    want = np.zeros(a.shape, int)
    for axis in range(3):
        for k in range(a.shape[axis]):
            part = np.take(a, k, axis)
            for label in (1, 2):
                marks = decoders.numbered(part == label)
                size = np.bincount(marks.ravel())
                place = [slice(None)] * 3
                place[axis] = k
                want[tuple(place)] |= (marks > 0) & (size[marks] < 4)
    assert all(got[p] == want[p] for p in np.ndindex(a.shape))


def test_offsets_of_dense_graphs():
    assert targets.half_ball(1) == [(-1, 0, 0), (0, -1, 0), (0, 0, -1)]
    assert len(targets.half_ball(1.8)) == 13 and set(targets.half_ball(1, 2)) == {(-1, 0), (0, -1)}
    below = targets.flat_and_below(1, 1.8)
    assert len(below) == 3 + 2 * 4 and all(o[0] == -1 for o in below[3:]) and len(set(below)) == len(below)


WITHOUT_SQL = sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL))


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_queries_without_sql_run(spark, data, name):
    rows = catalog.QUERIES[name](spark, data).collect()
    assert rows and len({tuple(map(str, r)) for r in rows}) == len(rows)


def test_one_to_one_pairs_equal_a_plain_loop(spark, data):
    """Greedy: a pair is dropped only if both of its sides are taken already."""
    candidates = catalog.QUERIES["select_union_pairs"](spark, data).collect()
    want = set()
    for key in {(r.i, r.j) for r in candidates}:
        a, b = set(), set()
        for r in sorted((r for r in candidates if (r.i, r.j) == key), key=lambda r: (-r.n, r.a, r.b)):
            if not (r.a in a and r.b in b):
                want.add((*key, r.a, r.b))
                a.add(r.a)
                b.add(r.b)
    assert {(r.i, r.j, r.a, r.b) for r in catalog.QUERIES["one_to_one_pairs"](spark, data).collect()} == want


def test_agglomeration_of_blocks_equals_plain_loops(spark, data):
    from stratovox.plans.decoders import _block_faces

    faces = defaultdict(lambda: defaultdict(list))
    for r in _block_faces(spark, data).collect():
        faces[r.block][r.u, r.v].append(r.aff)
    got = {(r.block, r.threshold, r.id): r.rep for r in catalog.QUERIES["agglomerate_thresholds"](spark, data).collect()}
    quantile = {(r.block, r.id): r.rep for r in catalog.QUERIES["agglomerate_quantile"](spark, data).collect()}
    history = defaultdict(list)
    for r in catalog.QUERIES["agglomerate_history"](spark, data).orderBy("block", "step").collect():
        history[r.block].append((r.kept, r.gone))
    graph = defaultdict(dict)
    for r in catalog.QUERIES["agglomerate_graph"](spark, data).collect():
        graph[r.block][r.u, r.v] = r.score
    n = Counter()
    for block in sorted(faces)[:3]:
        for t, (rep, _, _) in zip([0.5, 0.7, 0.9], plain_merging("aff50_his256", faces[block], [0.5, 0.7, 0.9])):
            assert {i: v for (b, s, i), v in got.items() if b == block and s == t} == {x: root(rep, x) for x in rep}
            n[t] += len(rep)
        rep = plain_merging("aff85_his0", faces[block], [0.8])[0][0]
        assert {i: v for (b, i), v in quantile.items() if b == block} == {x: root(rep, x) for x in rep}
        assert history[block] == [h[:2] for h in plain_merging("max10", faces[block], [0.7])[0][1]]
        assert graph[block] == pytest.approx({(u, v): s for u, v, s in plain_merging("min", faces[block], [0.7])[0][2]})
    assert sum(n.values())
