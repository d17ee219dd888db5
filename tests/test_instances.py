"""Instance decoders over whole volumes against plain loops."""

from __future__ import annotations

import random
from collections import deque
from itertools import product

import numpy as np
import pytest

from stratovox.operators import instances
from tests.test_kernels import plain_flood
from tests.test_operators import as_dict

SHAPE = (3, 7, 9)


def parts(mask):
    """Parts by faces, edges or corners, numbered in row-major order."""
    out, n = np.zeros(mask.shape, int), 0
    for start in zip(*np.nonzero(mask)):
        if out[start]:
            continue
        n += 1
        out[start], queue = n, deque([start])
        while queue:
            p = queue.popleft()
            for d in product((-1, 0, 1), repeat=3):
                q = tuple(a + b for a, b in zip(p, d))
                if all(0 <= k < s for k, s in zip(q, mask.shape)) and mask[q] and not out[q]:
                    out[q] = n
                    queue.append(q)
    return out


@pytest.fixture(scope="module")
def maps(spark):
    r = random.Random(3)
    a = np.array([[[[r.randrange(256) for _ in range(9)] for _ in range(7)] for _ in range(3)] for _ in range(3)])
    a[:, 2, 6, 8] = 255
    rows = [(*map(int, p), *(int(a[k][p]) for k in range(3))) for p in np.ndindex(SHAPE) if a[0][p] or r.random() < 0.5]
    return a, spark.createDataFrame(rows, "z int, y int, x int, s int, c int, d int")


def test_connected(maps):
    a, v = maps
    got = as_dict(instances.connected_instances(v, "s", above=0.7, smallest=2), "id")
    marks = parts(a[0] > int(255 * 0.7))
    keep = [k for k in range(1, marks.max() + 1) if (marks == k).sum() >= 2]
    assert got == {p: keep.index(marks[p]) + 1 if marks[p] in keep else 0 for p in np.ndindex(SHAPE)}


def test_connected_without_contours_grows(maps):
    a, v = maps
    got = as_dict(instances.connected_instances(v, "s", "c", 0.7, 0.5, (0, 1, 2), 1, "none"), "id")
    marks = parts((a[0] > int(255 * 0.7)) & (a[1] < 127))
    grown = {(z, y, x): marks[z, max(y - 1, 0) : y + 2, max(x - 2, 0) : x + 3].max() for z, y, x in np.ndindex(SHAPE)}
    left = sorted({k for k in grown.values() if k})
    assert got == {p: left.index(k) + 1 if k else 0 for p, k in grown.items()}


def test_floods_from_seeds(maps):
    a, v = maps
    got = as_dict(instances.flooded_instances(v, "s", "c", "d", 0.75, 0.6, 0.3, 0.1, -0.7, 2, 1, "none"), "id")
    signed = a[2] / 255 * 2 - 1
    ground = (a[0] > int(255 * 0.3)) & (signed > -0.7)
    seeds = parts((a[0] > int(255 * 0.75)) & (a[1] < int(255 * 0.6)) & (signed > 0.1))
    for k in range(1, seeds.max() + 1):
        if (seeds == k).sum() < 2:
            seeds[seeds == k] = 0
    found = np.array([got[p] for p in np.ndindex(SHAPE)]).reshape(SHAPE)
    marks = np.where(ground, seeds, 0)
    assert not found[~ground].any() and marks.any()
    level = plain_flood(np.where(ground, -a[0].astype(float), np.inf), marks)
    assert ((found > 0) == (ground & (level < np.inf))).all()
    for k in range(1, found.max() + 1):
        held = set(marks[found == k]) - {0}
        assert len(held) == 1 and (found[marks == held.pop()] == k).all()
        own = plain_flood(np.where(found == k, -a[0].astype(float), np.inf), np.where(found == k, marks, 0))
        assert np.allclose(own[found == k], level[found == k])


def test_given_seeds_small_objects_and_scaling(spark, maps):
    _, v = maps
    seeds = spark.createDataFrame([(2, 6, 8, 5)], "z int, y int, x int, seed long")
    got = as_dict(instances.flooded_instances(v, "s", above=0.0, seeds=seeds, smallest=1, factor=(1.0, 2.0, 1.0)), "id")
    assert len(got) == 3 * 14 * 9 and set(got.values()) <= {0, 1} and got[2, 13, 8] == 1
    assert set(as_dict(instances.flooded_instances(v, "s", above=0.0, seeds=seeds, smallest=10_000), "id").values()) == {0}
    assert set(as_dict(instances.connected_instances(v, "s", above=0.7, smallest=2, small_mode="neighbor"), "id").values()) > {0}
    with pytest.raises(ValueError):
        instances.connected_instances(v, "s", small_mode="other")
