"""Resampling, weights and flows against plain loops, and their edge cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratovox.operators import objects, warps
from tests.test_operators import as_dict


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(*p, v) for p, v in values.items()], f"z int, y int, x int, v {kind}")


def cloud(seed, shape, share=0.8):
    r = random.Random(seed)
    found = {p: round(r.random(), 4) for p in np.ndindex(shape) if r.random() < share}
    found[tuple(n - 1 for n in shape)] = 0.5
    return found


def interpolated(values, place):
    total = 0.0
    low = [math.floor(s) for s in place]
    for corner in np.ndindex(2, 2, 2):
        w = math.prod(s - k if u else 1 - (s - k) for s, k, u in zip(place, low, corner))
        total += w * values.get(tuple(k + u for k, u in zip(low, corner)), 0.0)
    return total


@pytest.mark.parametrize("target", [(3, 9, 4), (1, 5, 7), (6, 11, 13), (5, 2, 3), (2, 5, 1)])
def test_linear_resizing(spark, target):
    shape = (3, 5, 7)
    values = cloud(1, shape)
    got = as_dict(warps.resized_linear(frame(spark, values), "v", target), "v")
    want = {p: interpolated(values, [k * (n - 1) / (m - 1) if m > 1 else 0.0 for k, n, m in zip(p, shape, target)]) for p in np.ndindex(target)}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], abs=1e-12) for p in want)


def test_flat_axes_and_empty_volumes(spark):
    got = as_dict(warps.resized_linear(frame(spark, {(0, 0, 0): 2.0, (0, 0, 1): 4.0}), "v", (3, 1, 3)), "v")
    assert got == {(z, 0, x): 2.0 + x for z in range(3) for x in range(3)}
    for found in (warps.resized_linear(frame(spark, {(0, 0, 0): 1.0}).limit(0), "v", (3, 1, 3)), warps.rotated(frame(spark, {(0, 0, 0): 1.0}).limit(0), "v", 5.0)):
        assert found.count() == 0


@pytest.mark.parametrize("clamp", [False, True])
def test_turning_by_any_angle(spark, clamp):
    shape, turn = (2, 6, 9), math.radians(-37)
    values = cloud(2, shape)
    got = as_dict(warps.rotated(frame(spark, values), "v", -37.0, clamp=clamp), "v")
    for z, y, x in np.ndindex(shape):
        sy, sx = math.cos(turn) * (y - 2.5) - math.sin(turn) * (x - 4) + 2.5, math.sin(turn) * (y - 2.5) + math.cos(turn) * (x - 4) + 4
        if clamp:
            sy, sx = min(max(sy, 0), 5), min(max(sx, 0), 8)
        assert got[z, y, x] == pytest.approx(interpolated(values, (z, sy, sx)), abs=1e-9)
    assert as_dict(warps.rotated(frame(spark, values), "v", 0.0), "v") == {p: values.get(p, 0.0) for p in np.ndindex(shape)}


def test_half_a_turn_of_labels(spark):
    values = {p: 1 + p[1] * 4 + p[2] for p in np.ndindex(1, 3, 4)}
    got = as_dict(warps.rotated(frame(spark, values, "long"), "v", 180.0, linear=False), "v")
    assert got == {(0, y, x): values[0, 2 - y, 3 - x] for _, y, x in values}


def test_displacement_without_a_place_is_background(spark):
    values = cloud(3, (1, 4, 5), 1.0)
    field = {"y": F.when(F.col("x") != 2, F.lit(1.0)), "x": F.lit(0.25)}
    got = as_dict(warps.displaced(frame(spark, values), "v", field), "v")
    for _, y, x in values:
        assert got[0, y, x] == (0.0 if x == 2 else pytest.approx(interpolated(values, (0, y + 1, x + 0.25))))


def test_weights_between_objects(spark):
    r = random.Random(4)
    label = {p: r.choice([1, 2, 3]) for p in np.ndindex(3, 14, 15) if r.random() < 0.04 and p[0] < 2}
    label[0, 0, 0] = label[1, 13, 14] = 1
    label[2, 3, 3] = 5  # a slice of one object
    got = as_dict(objects.border_weights(frame(spark, label, "long"), "v", 10.0, 5.0, 3.0), "weight")
    assert len(got) == 3 * 14 * 15
    for z, y, x in got:
        near = {}
        for (k, b, c), v in label.items():
            if k == z:
                near[v] = min(near.get(v, math.inf), math.hypot(y - b, x - c))
        two = sorted(near.values())[:2]
        want = 5.0 if (z, y, x) in label else max(1.0, 10 * math.exp(-(sum(two) ** 2) / 18)) if len(two) == 2 else 1.0
        assert got[z, y, x] == pytest.approx(want)
    assert objects.border_weights(frame(spark, label, "long").limit(0), "v").count() == 0


def plain_flows(slice_):
    """All objects of a slice at once, in one padded array."""
    h, w = slice_.shape
    label = np.pad(slice_, 1)
    centres, most = [], 0
    for k in np.unique(slice_[slice_ > 0]):
        y, x = np.nonzero(slice_ == k)
        i = np.argmin((x - np.median(x)) ** 2 + (y - np.median(y)) ** 2)
        centres.append((y[i] + 1, x[i] + 1))
        most = max(most, 2 * (y.max() - y.min() + 2 + x.max() - x.min() + 2))
    heat = np.zeros(label.shape)
    for _ in range(most):
        for c in centres:
            heat[c] += 1
        new = np.zeros_like(heat)
        for y in range(1, h + 1):
            for x in range(1, w + 1):
                if label[y, x]:
                    new[y, x] = sum(heat[y + a, x + b] for a in (-1, 0, 1) for b in (-1, 0, 1) if label[y + a, x + b] == label[y, x]) / 9
        heat = new
    heat = np.log1p(heat)
    out = {}
    for y, x in zip(*np.nonzero(slice_)):
        dy, dx = heat[y + 2, x + 1] - heat[y, x + 1], heat[y + 1, x + 2] - heat[y + 1, x]
        n = 1e-20 + math.hypot(dy, dx)
        out[int(y), int(x)] = (dy / n, dx / n)
    return out


def test_flows_equal_a_plain_loop(spark):
    a = np.zeros((2, 13, 15), int)
    a[0, 1:9, 2:9], a[0, 3:6, 9:14], a[0, 10:12, 1:3], a[1, 5, 5], a[1, 0:4, 0:14] = 4, 2, 9, 4, 7
    a[0, 4:7, 4:6] = 0
    label = {p: int(a[p]) for p in np.ndindex(a.shape) if a[p]}
    got = {(r.z, r.y, r.x): (r.dy, r.dx) for r in objects.flows(frame(spark, label, "long"), "v").collect()}
    want = {(z, *p): v for z in range(2) for p, v in plain_flows(a[z]).items()}
    assert got.keys() == want.keys()
    assert all(got[p] == pytest.approx(want[p], abs=1e-8) for p in want)
