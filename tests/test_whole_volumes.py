"""Watershed, distances, seeds and quantiles over whole volumes, against plain loops."""

from __future__ import annotations

import math
import random
from collections import Counter, deque

import numpy as np
import pytest

from stratovox.operators import distances, quantiles, seeds, watershed

STEPS = [(-1, 0, 0), (0, -1, 0), (0, 0, -1), (1, 0, 0), (0, 1, 0), (0, 0, 1)]


def frame(spark, values, fields="a double"):
    """``values``: a tuple of values for each voxel that has a row."""
    return spark.createDataFrame([(*p, *v) for p, v in values.items()], f"z int, y int, x int, {fields}")


def plain_basins(aff, low, high):
    """Plateaus are divided level by level from their corners; basins by following directions until a core is reached."""
    def edge(p, d):
        q = tuple(a + b for a, b in zip(p, STEPS[d]))
        if q not in aff:
            return low, None
        return (aff[p] if d < 3 else aff[q])[d % 3], q

    steep = {}
    for p in aff:
        near = [edge(p, d) for d in range(6)]
        m = max(a for a, _ in near)
        steep[p] = {d: q for d, (a, q) in enumerate(near) if m > low and (a == m or a >= high) and q is not None}
    mutual = {p: {d: q for d, q in s.items() if (d + 3) % 6 in steep[q]} for p, s in steep.items()}
    go, level = {}, {}
    for p, s in steep.items():
        if len(s) > len(mutual[p]):
            go[p], level[p] = s[max(d for d in s if d not in mutual[p])], 0
    k = 0
    while any(v == k for v in level.values()):
        for p in [p for p in aff if p not in level and any(level.get(q) == k for q in mutual[p].values())]:
            go[p] = mutual[p][max(d for d, q in mutual[p].items() if level.get(q) == k)]
            level[p] = k + 1
        k += 1
    links = {p: set() for p in aff}
    for p, q in [*go.items(), *((p, q) for p in aff if p not in level for q in mutual[p].values() if q not in level)]:
        links[p].add(q)
        links[q].add(p)
    out = {}
    for p in sorted(aff):
        if p in out or not steep[p]:
            continue
        queue = deque([p])
        out[p] = p
        while queue:
            for q in links[queue.popleft()]:
                if q not in out:
                    out[q] = p
                    queue.append(q)
    return out


@pytest.mark.parametrize("levels, low, high, holes", [(3, 0.0, 1.0, 0.0), (5, 0.2, 0.75, 0.2), (1000, 0.0, 1.0, 0.0)])
def test_basins_equal_a_plain_loop(spark, levels, low, high, holes):
    r = random.Random(levels)
    aff = {(z, y, x): tuple(math.floor(r.random() * levels) / levels for _ in range(3)) for z in range(4) for y in range(9) for x in range(11) if r.random() >= holes}
    for y in range(2, 7):  # a plateau with one way out
        for x in range(2, 9):
            aff[1, y, x] = (0.1, 0.9, 0.9)
    v = frame(spark, aff, "az double, ay double, ax double")
    got = {(r.z, r.y, r.x): r.basin for r in watershed.affinity_watershed(v, {a: f"a{a}" for a in "zyx"}, low, high).collect()}
    size = (max(p[1] for p in aff) + 1, max(p[2] for p in aff) + 1)
    want = {p: (q[0] * size[0] + q[1]) * size[1] + q[2] + 1 for p, q in plain_basins(aff, low, high).items()}
    assert got == {p: want.get(p, 0) for p in aff}


def test_a_plateau_is_divided_by_hops(spark):
    """A long plateau between two higher ends goes half to each, whatever blocks it crosses."""
    aff = {(0, 0, x): (0.0, 0.0, 0.5) for x in range(25)}
    aff[0, 0, 1], aff[0, 0, 24] = (0.0, 0.0, 0.9), (0.0, 0.0, 0.9)
    got = [r.basin for r in watershed.affinity_watershed(frame(spark, aff, "az double, ay double, ax double"), {a: f"a{a}" for a in "zyx"}).orderBy("x").collect()]
    assert got[:12] == [1] * 12 and got[13:] == [got[24]] * 12 and got[24] != 1
    assert watershed.affinity_watershed(frame(spark, aff, "az double, ay double, ax double").limit(0), {a: f"a{a}" for a in "zyx"}).count() == 0


@pytest.mark.parametrize("side", [4, 5])
def test_basins_across_blocks_equal_a_plain_loop(spark, side):
    """Blocks smaller than the plateaus: hops and basins go on over faces, edges of blocks and missing rows."""
    r = random.Random(side)
    aff = {(z, y, x): tuple(math.floor(r.random() * 3) / 3 for _ in range(3)) for z in range(9) for y in range(10) for x in range(11) if r.random() >= 0.1}
    for p in [(z, y, x) for z in range(2, 8) for y in range(1, 9) for x in range(1, 10)]:  # a plateau with one way out
        if p in aff:
            aff[p] = (0.8, 0.8, 0.8)
    aff[2, 1, 1] = (0.9, 0.1, 0.1)
    got = {(q.z, q.y, q.x): q.basin for q in watershed.affinity_watershed(frame(spark, aff, "az double, ay double, ax double"), {a: f"a{a}" for a in "zyx"}, 0.0, 1.0, (10, 11), side).collect()}
    want = {p: (q[0] * 10 + q[1]) * 11 + q[2] + 1 for p, q in plain_basins(aff, 0.0, 1.0).items()}
    assert got == {p: want.get(p, 0) for p in aff}


def test_rounds_grow_with_the_blocks_that_hops_cross(spark, monkeypatch):
    """A plateau of 200 voxels in a row takes a round for each of its seven blocks, not one for each hop; nulls are no affinity."""
    rounds, kept = [], watershed.saved
    monkeypatch.setattr(watershed, "saved", lambda df, name="stage": rounds.append(name) or kept(df, name))
    aff = {(0, 0, x): (None, None, 0.5) for x in range(201)}
    aff[0, 0, 1] = (None, None, 0.9)
    aff[0, 0, 200] = (None, None, 0.4)
    got = watershed.affinity_watershed(frame(spark, aff, "az double, ay double, ax double"), {a: f"a{a}" for a in "zyx"}).collect()
    assert {r.basin for r in got} == {1} and len(got) == 201 and len(rounds) <= 12


def brute_distances(label, spacing):
    out = {}
    for p, k in label.items():
        other = [sum(((a - b) * s) ** 2 for a, b, s in zip(p, q, spacing)) for q, m in label.items() if m != k]
        out[p] = 0.0 if k == 0 else math.sqrt(min(other)) if other else -1.0
    return out


@pytest.mark.parametrize("spacing, labels, background", [((3.0, 1.0, 1.0), 3, 0.15), ((1.0, 2.5, 0.5), 2, 0.02), ((1.0, 1.0, 1.0), 1, 0.005)])
def test_distances_equal_brute_force(spark, spacing, labels, background, monkeypatch):
    monkeypatch.setattr(distances, "CELLS", 300)
    r = random.Random(labels)
    shape = (5, 9, 12)
    label = {p: 0 if r.random() < background else 1 + (p[2] // 5 + p[1] // 4) % labels for p in np.ndindex(shape)}
    label[4, 8, 11], label[0, 0, 0] = 1, 1  # corners of the bounding box
    rows = {p: (k,) for p, k in label.items() if k}  # background has no rows
    got = {(r.z, r.y, r.x): r.distance for r in distances.distance_transform(frame(spark, rows, "l long"), "l", spacing).collect()}
    want = brute_distances(label, spacing)
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def test_distances_of_a_bar_in_a_given_box(spark):
    rows = {(0, 2, x): (1,) for x in range(6)}
    got = {(r.y, r.x): r.distance for r in distances.distance_transform(frame(spark, rows, "l long"), "l", low=(0, 0, 0), high=(1, 5, 6)).collect()}
    assert got == {(y, x): 1.0 if y == 2 else 0.0 for y in range(5) for x in range(6)}
    assert {r.distance for r in distances.distance_transform(frame(spark, rows, "l long"), "l").collect()} == {-1.0}
    assert distances.distance_transform(frame(spark, rows, "l long").limit(0), "l").count() == 0


def test_lower_envelope():
    r = np.random.default_rng(1)
    f = np.where(r.random((50, 31)) < 0.5, np.inf, np.floor(r.random((50, 31)) * 40))
    f[0], f[1] = np.inf, 0.0
    q = np.arange(31)
    for step in (1.0, 0.3, 7.0):
        want = (f[:, None, :] + (step * (q[:, None] - q)) ** 2).min(axis=2)
        assert np.allclose(distances.lower_envelope(f, step), want)


def test_far_sides_are_not_cut_off(spark):
    rows = {(0, 0, 0): (True, False), (0, 0, 40): (False, True), (0, 3, 36): (False, True), (0, 0, 7): (False, False)}
    from pyspark.sql import functions as F

    got = {r.side: r for r in distances.side_distances(frame(spark, rows, "a boolean, b boolean"), F.col("a"), F.col("b"), (1.0, 1.0, 1.0), 36.2).collect()}
    near, far = math.sqrt(36**2 + 9), 40.0
    assert got[0].mean == pytest.approx(near) and got[0].n == 1 and got[0]["std"] == 0.0 and got[0].far == 0
    assert got[1].mean == pytest.approx((near + far) / 2) and got[1].most == far and got[1].median == pytest.approx((near + far) / 2) and got[1].far == 1
    none = frame(spark, {(0, 0, 0): (True, False), (0, 1, 0): (False, False)}, "a boolean, b boolean")
    assert distances.side_distances(none, F.col("a"), F.col("b"), (1.0, 1.0, 1.0)).count() == 0


@pytest.mark.parametrize("accuracy, few", [(10_000, 4096), (100, 7)])
def test_quantiles_are_exact(spark, accuracy, few, monkeypatch):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "FEW", few)
    r = np.random.default_rng(2)
    shares = [0.0, 0.01, 0.5, 0.7, 0.999, 1.0]
    for values in (r.normal(0, 1, 3000), np.concatenate([np.full(2000, 3.25), r.random(900)]), np.full(500, -7.0), np.array([1.0, 2.0]), np.exp(r.normal(0, 80, 1500)), np.round(r.random(3000), 2)):
        rows = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        assert quantiles.exact_quantiles(rows, "v", shares) == pytest.approx(np.quantile(values, shares).tolist(), rel=1e-12)
    assert quantiles.exact_quantiles(rows.limit(0), "v", shares) == []


def test_normalised_constants_are_null(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, v double")
    assert {r.v for r in quantiles.normalised(rows, "v").collect()} == {None}
    rows = spark.createDataFrame([(k, float(k)) for k in range(101)], "k int, v double")
    assert quantiles.normalised(rows, "v").where("k = 1 and v = 0 or k = 99 and v = 1").count() == 2


def test_extrema_equal_a_plain_loop(spark):
    r = random.Random(4)
    value = {(z, y, x): (float(r.randrange(4)),) for z in range(3) for y in range(8) for x in range(9) if r.random() < 0.9}
    value[0, 0, 0] = (None,)
    known = {p: v for p, (v,) in value.items() if v is not None}
    for axes, lowest in ((("z", "y", "x"), True), (("y", "x"), False)):
        steps = [s for s in STEPS if all(not s[k] or "zyx"[k] in axes for k in range(3))]
        near = lambda p: [q for q in (tuple(a + b for a, b in zip(p, s)) for s in steps) if q in known]
        want, seen = {}, set()
        for p in sorted(known):
            if p in seen:
                continue
            group, queue = {p}, deque([p])
            while queue:
                for q in near(queue.popleft()):
                    if known[q] == known[p] and q not in group:
                        group.add(q)
                        queue.append(q)
            seen |= group
            if all(known[q] >= known[p] if lowest else known[q] <= known[p] for g in group for q in near(g)):
                want.update({g: (p[0] * 8 + p[1]) * 9 + p[2] + 1 for g in group})
        got = {(r.z, r.y, r.x): r.seed for r in seeds.regional_extrema(frame(spark, value), "a", lowest, axes, (8, 9)).collect()}
        assert got == want


def test_interior_seeds_equal_a_plain_loop(spark):
    r = random.Random(5)
    shape = (4, 12, 14)
    boundary = {p: (round(r.random() ** 0.5, 3),) for p in np.ndindex(shape)}
    for p in np.ndindex(shape):
        if 2 <= p[1] <= 6 and 3 <= p[2] <= 11:
            boundary[p] = (0.1,)
    got = {(r.z, r.y, r.x): r.seed for r in seeds.interior_seeds(frame(spark, boundary), "a", 0.4, 2).collect()}
    inside = {p: int(1 - v > 0.4) for p, (v,) in boundary.items()}
    far = {p: d for p, d in brute_distances(inside, (1, 1, 1)).items() if inside[p]}
    box = lambda p, q: max(abs(a - b) for a, b in zip(p, q)) <= 2
    peaks = [p for p in sorted(far) if far[p] == max(d for q, d in far.items() if box(p, q))]
    kept = []
    for p in peaks:
        if not any(box(p, q) for q in kept):
            kept.append(p)
    assert got == {p: k + 1 for k, p in enumerate(sorted(kept))} and len(kept) > 3
    assert len(peaks) > len(kept)


def test_seeds_fall_back(spark):
    dark = {(0, 0, x): (0.9 + x / 1000,) for x in range(10)}  # nowhere above the threshold: the 70th percentile of the interior
    assert [(r.x, r.seed) for r in seeds.interior_seeds(frame(spark, dark), "a", 0.4, 3).collect()] == [(0, 1)]
    light = {(0, y, x): (0.0,) for y in range(3) for x in range(3)}  # no border at all: one seed
    assert [(r.y, r.x, r.seed) for r in seeds.interior_seeds(frame(spark, light), "a", 0.4, 3).collect()] == [(0, 0, 1)]
    assert seeds.interior_seeds(frame(spark, light).limit(0), "a").count() == 0


@pytest.mark.parametrize("method", ["grid", "minima", "maxima_distance"])
def test_supervoxels_follow_the_lowest_paths(spark, method):
    from stratovox.operators import supervoxels
    from tests.test_kernels import plain_flood

    r = np.random.default_rng(6)
    height = np.round(r.random((2, 9, 11)), 2)
    v = frame(spark, {tuple(map(int, p)): (float(height[p]),) for p in np.ndindex(height.shape)})
    marks = np.zeros(height.shape, int)
    for s in supervoxels.slice_seeds(v, "a", method, 4).collect():
        marks[s.z, s.y, s.x] = s.seed
    found = np.zeros(height.shape, int)
    for s in supervoxels.slice_supervoxels(v, "a", method, 4).collect():
        found[s.z, s.y, s.x] = s.id
    assert set(found.ravel()) == set(range(1, len(set(marks[marks > 0])) + 1)) and not set(found[0].ravel()) & set(found[1].ravel())
    for z in range(2):
        level = plain_flood(height[z], marks[z])
        for k in set(found[z].ravel()):
            area = found[z] == k
            assert len(set(marks[z][area]) - {0}) == 1
            own = plain_flood(np.where(area, height[z], np.inf), np.where(area, marks[z], 0))
            assert np.allclose(own[area], level[area])
    with pytest.raises(ValueError):
        supervoxels.slice_seeds(v, "a", "other")


def test_flooding_a_volume_follows_the_lowest_paths(spark):
    from stratovox.operators import flooding
    from tests.test_kernels import plain_flood

    r = np.random.default_rng(8)
    height = np.round(r.random((3, 7, 8)), 1)  # ties
    marks = np.zeros(height.shape, int)
    for k, p in enumerate([(0, 0, 0), (2, 6, 7), (1, 3, 3), (0, 5, 1)], 1):
        marks[p] = 10 * k
    marks[0, 0, 1] = 10
    wall = {(1, 0, 7), (1, 1, 6), (1, 1, 7), (0, 0, 7), (0, 1, 7), (2, 0, 7), (2, 1, 7), (0, 0, 6), (2, 0, 6)}  # around one voxel, which no seed reaches
    rows = {tuple(map(int, p)): (float(height[p]), int(marks[p]) or None) for p in np.ndindex(height.shape) if p not in wall - {(1, 0, 7)}}
    for p in ((1, 0, 6),):
        rows.pop(p, None)
    found = np.zeros(height.shape, int)
    got = flooding.seeded_watershed(frame(spark, rows, "h double, s long"), "h", "s").collect()
    assert len(got) == len(rows)
    for s in got:
        found[s.z, s.y, s.x] = s.id
    open_ = np.array([p in rows for p in np.ndindex(height.shape)]).reshape(height.shape)
    assert found[1, 0, 7] == 0 and (found[open_] > 0).sum() == len(rows) - 1 and (found[marks > 0] == marks[marks > 0]).all()
    level = plain_flood(np.where(open_, height, np.inf), marks)
    for k in (10, 20, 30, 40):
        own = plain_flood(np.where(found == k, height, np.inf), np.where(found == k, marks, 0))
        assert np.allclose(own[found == k], level[found == k])
    assert flooding.seeded_watershed(frame(spark, rows, "h double, s long").limit(0), "h", "s").count() == 0
    assert {s.id for s in flooding.seeded_watershed(frame(spark, {p: (h, None) for p, (h, _) in rows.items()}, "h double, s long"), "h", "s").collect()} == {0}
