"""Operators on hand-made volumes and graphs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratovox.operators import grid, labels, metrics, overlap, regions, stencils, volumes
from stratovox.operators.components import components
from stratovox.sources import volumes as sources


def volume(spark, values, name="v"):
    rows = [(z, y, x, v) for z, plane in enumerate(values) for y, line in enumerate(plane) for x, v in enumerate(line)]
    return spark.createDataFrame(rows, f"z int, y int, x int, {name} long")


def as_dict(df, name):
    return {(r.z, r.y, r.x): r[name] for r in df.collect()}


def test_components_of_random_graphs(spark):
    r = random.Random(3)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_two_label_cube(spark):
    cube = volume(spark, [[[1, 1], [1, 1]], [[2, 2], [2, 2]]]).withColumn("aff", F.lit(0.5))
    faces = regions.faces(cube, "v", {a: "aff" for a in "zyx"})
    assert [tuple(r) for r in regions.graph(faces, "contact", "max").collect()] == [(1, 2, 4, 0.5)]


def test_shifted_square_has_no_match(spark):
    inside = (F.col("y") >= 10) & (F.col("y") < 20) & (F.col("x") >= 10) & (F.col("x") < 20)
    moved = (F.col("y") >= 15) & (F.col("y") < 25) & (F.col("x") >= 10) & (F.col("x") < 20)
    grid_ = spark.range(10_000).select(F.expr("cast(id div 100 as int) y"), F.expr("cast(id % 100 as int) x"))
    row = metrics.matching(grid_.select(inside.cast("long").alias("t"), moved.cast("long").alias("p")), "t", "p", 0.75).first()
    assert (row.tp, row.fp, row.fn, row.n_true, row.n_pred, row.f1) == (0, 1, 1, 1, 1, 0.0)


def test_matching_at_low_overlaps_is_the_best_assignment(spark):
    from itertools import permutations

    from stratovox.operators.kernels import best_assignment

    r = random.Random(8)
    for _ in range(60):
        n, m = r.randrange(1, 5), r.randrange(1, 5)
        gain = np.array([[r.random() for _ in range(m)] for _ in range(n)])
        small, large = (gain, m) if n <= m else (gain.T, n)
        best = max(sum(small[i, p] for i, p in enumerate(order)) for order in permutations(range(large), min(n, m)))
        assert sum(gain[i, j] for i, j in best_assignment(gain)) == pytest.approx(best)
    rows = [(1, 1)] * 4 + [(1, 2)] * 5 + [(2, 2)] * 3 + [(2, 3)] * 2 + [(0, 4)]
    row = metrics.matching(spark.createDataFrame(rows, "t long, p long"), "t", "p", 0.3).first()
    assert (row.tp, row.n_true, row.n_pred) == (2, 2, 4)
    assert row.mean_matched_score == pytest.approx((4 / 9 + 2 / 5) / 2)


def test_block_grid_of_a_small_volume(spark):
    sizes = spark.createDataFrame([(3, 3, 3)], "nz int, ny int, nx int")
    assert [tuple(r) for r in grid.blocks(sizes, (8, 8, 8), (2, 2, 2)).collect()] == [(0, 0, 3, 0, 3, 0, 3)]


def test_chunk_grid_of_known_size(spark):
    sizes = spark.createDataFrame([(2410, 1840, 1650)], "nz int, ny int, nx int")
    rows = grid.chunks(sizes, (512,) * 3, (64,) * 3).orderBy("cz", "cy", "cx").collect()
    assert len(rows) == 6 * 4 * 4
    last = rows[-1]
    assert (last.z2 - last.z1, last.y2 - last.y1, last.x2 - last.x1) == (170, 496, 306)


def test_split_and_merge_round_trip(spark):
    v = volume(spark, [[[z * 100 + y * 10 + x for x in range(7)] for y in range(5)] for z in range(4)])
    parts = grid.in_chunks(v, (3, 3, 4), (1, 1, 2))
    assert as_dict(grid.merged_chunks(parts, ["v"], (3, 3, 4), (1, 1, 2)), "v") == as_dict(v, "v")


def test_box_pairs_equal_nested_loop(spark):
    boxes = grid.blocks(spark.createDataFrame([(40, 40, 40)], "nz int, ny int, nx int"), (8,) * 3, (2,) * 3)
    rows = boxes.collect()
    want = sum(
        all(max(a[1 + 2 * k], b[1 + 2 * k]) < min(a[2 + 2 * k], b[2 + 2 * k]) for k in range(3)) for a in rows for b in rows if a.idx < b.idx
    )
    assert grid.box_pairs(boxes, (8,) * 3).count() == want == 3258


def test_one_object_across_two_blocks(spark):
    rows = [(0, 0, 0, x, 1) for x in range(4)] + [(1, 0, 0, x, 1) for x in range(2, 6)] + [(1, 0, 0, 6, 2)]
    local = spark.createDataFrame(rows, "idx long, z int, y int, x int, id long")
    table = overlap.offsets(overlap.block_sizes(local))
    assert {r.idx: r.offset for r in table.collect()} == {0: 1, 1: 2}
    shifted = overlap.with_offsets(local, table)
    pairs = overlap.selected(overlap.pair_counts(shifted), min_voxels=2)
    assert [(r.a, r.b, r.n) for r in pairs.collect()] == [(2, 3, 2)]
    out = as_dict(overlap.applied(shifted, overlap.representatives(pairs)), "id")
    assert {out[0, 0, x] for x in range(6)} == {2} and out[0, 0, 6] == 4


def test_grid_components_equal_flood_fill(spark):
    r = random.Random(5)
    values = [[[r.choice([0, 1, 1, 2]) for _ in range(6)] for _ in range(5)] for _ in range(4)]
    got = as_dict(labels.grid_components(volume(spark, values), "v"), "component")
    seen = {}
    for z in range(4):
        for y in range(5):
            for x in range(6):
                if values[z][y][x] and (z, y, x) not in seen:
                    todo, number = [(z, y, x)], (z * 5 + y) * 6 + x + 1
                    while todo:
                        a, b, c = todo.pop()
                        if (a, b, c) in seen or not (0 <= a < 4 and 0 <= b < 5 and 0 <= c < 6) or values[a][b][c] != values[z][y][x]:
                            continue
                        seen[a, b, c] = number
                        todo += [(a - 1, b, c), (a + 1, b, c), (a, b - 1, c), (a, b + 1, c), (a, b, c - 1), (a, b, c + 1)]
    assert got == {p: seen.get(p, 0) for p in got}


def test_empty_and_single_voxel_volumes(spark):
    nothing = volume(spark, [[[0, 0], [0, 0]]])
    assert set(as_dict(labels.compacted(nothing, "v"), "v").values()) == {0}
    assert labels.sizes(nothing, "v").count() == 0
    assert as_dict(labels.grid_components(volume(spark, [[[7]]]), "v"), "component") == {(0, 0, 0): 1}


def test_compaction_with_gaps(spark):
    assert as_dict(labels.compacted(volume(spark, [[[0, 900, 5000, 17, 900]]]), "v"), "v") == dict(zip(((0, 0, x) for x in range(5)), (0, 2, 3, 1, 2)))


def test_island_is_removed(spark):
    v = volume(spark, [[[1] * 5, [1, 1, 9, 1, 1], [1] * 5]])
    assert sum(x == 0 for x in as_dict(labels.size_filtered(v, "v", smallest=2), "v").values()) == 1


def test_score_text(spark):
    one = F.lit(1.0)
    row = spark.range(1).select(regions.divided(one, F.lit(0.0)).alias("a"), regions.stepped(one, F.lit(2.0)).alias("b"), (regions.inverted(F.lit(4.0)) - 0.25).alias("c")).first()
    assert row.a > 1e308 and row.b == 0.0 and row.c == 0.0


def test_nearest_other_of_far_points(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 0.0, 3.0, 4.0), (3, 900.0, 0.0, 0.0)], "k long, cz double, cy double, cx double")
    got = {r.k: round(r.distance, 3) for r in labels.nearest_other(points, "k", 2.0).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 900.0}


def test_stored_blocks_read_back(spark, tmp_path):
    v = volume(spark, [[[z + y + x for x in range(9)] for y in range(4)] for z in range(4)])
    path = str(tmp_path / "blocks")
    sources.write_blocks(v, path, (2, 2, 4))
    part = sources.read_blocks(spark, path, (2, 2, 4), (1, 0, 3), (3, 2, 8))
    assert as_dict(part, "v") == {k: n for k, n in as_dict(v, "v").items() if 1 <= k[0] < 3 and k[1] < 2 and 3 <= k[2] < 8}
    assert "PartitionFilters: [isnotnull" in part._jdf.queryExecution().toString()


def test_affinities_and_erosion_at_the_border(spark):
    v = volume(spark, [[[1, 1, 2]]])
    aff = {r.x: (r.aff_z, r.aff_y, r.aff_x) for r in stencils.affinities(v, "v").collect()}
    assert aff == {0: (1, 1, 1), 1: (1, 1, 1), 2: (1, 1, 0)}
    assert set(as_dict(stencils.eroded(v.withColumn("m", F.lit(1)), "m", (0, 0, 1), "e"), "e").items()) == {((0, 0, 0), 0), ((0, 0, 1), 1), ((0, 0, 2), 0)}


def test_pyramid_levels(spark):
    v = volume(spark, [[[1 + x // 4 for x in range(8)] for _ in range(8)] for _ in range(4)])
    counts = {r.mip: r.n for r in volumes.pyramid(v, "v", (1, 2, 2), 2).groupBy("mip").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 64, 2: 16}


def test_merging_equals_a_plain_loop():
    import pandas as pd

    from stratovox.operators.kernels import merged_cheapest_first

    r = random.Random(8)
    for _ in range(30):
        edges = {}
        for _ in range(25):
            u, v = sorted(r.sample(range(1, 11), 2))
            n = r.randrange(1, 5)
            t, k = edges.get((u, v), (0.0, 0))
            edges[u, v] = (t + n * r.random(), k + n)
        got = merged_cheapest_first(pd.DataFrame([(*k, *v) for k, v in edges.items()], columns=["u", "v", "total", "n"]), 0.55)
        want = []
        while edges:
            score, (u, v) = min((1 - t / n, k) for k, (t, n) in edges.items())
            if score >= 0.55:
                break
            want.append((u, v))
            new = {}
            for (a, b), (t, n) in edges.items():
                a, b = sorted((u if a == v else a, u if b == v else b))
                if a != b:
                    s, k = new.get((a, b), (0.0, 0))
                    new[a, b] = (s + t, k + n)
            edges = new
        assert [x[:2] for x in got] == want


def test_distances_and_flooding():
    import numpy as np

    from stratovox.operators.kernels import flooded, squared_distances

    r = np.random.default_rng(2)
    outside = r.random((3, 4, 5)) < 0.1
    got = squared_distances(outside, (2.0, 1.0, 1.0))
    for p in np.ndindex(outside.shape):
        d = [4 * (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2 for q in zip(*np.nonzero(outside))]
        assert got[p] == (min(d) if d else np.inf)
    height = np.array([[0, 5, 0, 1, 9, 0]])
    assert flooded(height, np.array([[1, 0, 2, 0, 0, 3]])).tolist() == [[1, 1, 2, 2, 3, 3]] or flooded(height, np.array([[1, 0, 2, 0, 0, 3]]))[0, 3] == 2


def test_random_label_pair_in_chunks_equals_the_whole(spark):
    """Counts of five chunks added up give the scores of the whole volume."""
    v = spark.range(4000).select(F.expr("cast(id div 400 as int) z"), F.expr("cast(id div 20 % 20 as int) y"), F.expr("cast(id % 20 as int) x"), F.expr("id * 7919 % 13 a"), F.expr("id * 104729 % 11 b"))
    whole = metrics.rand_and_information(metrics.contingency(v, "a", "b", (0,), ()), "a", "b").first()
    parts = [metrics.contingency(v.where(f"z div 2 = {k}"), "a", "b", (0,), ()) for k in range(5)]
    added = parts[0]
    for p in parts[1:]:
        added = added.unionByName(p)
    again = metrics.rand_and_information(added.groupBy("a", "b").agg(F.sum("n").alias("n")), "a", "b").first()
    assert all(abs(x - y) < 1e-12 for x, y in zip(whole, again))


def test_filled_volumes_run_no_jobs_while_they_are_planned(spark):
    from stratovox.operators import stencils

    v = volume(spark, [[[1, 1, 2], [0, 2, 2]]])
    spark.sparkContext.setJobGroup("planning", "plans of filled volumes")
    try:
        planned = [stencils.affinities(v, "v", filled=True), stencils.boundaries(v, "v", filled=True), stencils.widened_border(v, "v", filled=True),
                   stencils.eroded(v, "v", (0, 1, 1), "e", filled=True), stencils.majority(v, v["v"] > 1, (0, 1, 1), filled=True)]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [sorted(map(tuple, p.collect())) for p in planned[:3]] == [sorted(map(tuple, p.collect())) for p in (stencils.affinities(v, "v"), stencils.boundaries(v, "v"), stencils.widened_border(v, "v"))]
