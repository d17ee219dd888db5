"""Peaks that keep apart, against a plain loop in the order of their indices."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest

from stratovox.operators import seeds


@pytest.mark.parametrize("side", [2, 5, 64])
def test_spaced_peaks_equal_plain_loop(spark, monkeypatch, side):
    monkeypatch.setattr(seeds, "SIDE", side)
    r = np.random.default_rng(2)
    value, distance = r.integers(0, 3, (6, 7, 8)).astype(float), 1
    padded = np.pad(value, distance)
    kept = []
    for p in product(*map(range, value.shape)):
        box = padded[tuple(slice(k, k + 2 * distance + 1) for k in p)]
        if value[p] > 0 and value[p] == box.max() and all(max(abs(a - b) for a, b in zip(p, q)) > distance for q in kept):
            kept.append(p)
    rows = [(*p, (p[0] * 7 + p[1]) * 8 + p[2] + 1, float(value[p])) for p in product(*map(range, value.shape))]
    found = seeds.spaced_peaks(spark.createDataFrame(rows, "z int, y int, x int, index_ long, v double"), "v", distance).collect()
    assert sorted((r.z, r.y, r.x) for r in found) == kept


def test_a_chain_of_equal_peaks_takes_few_rounds(spark, monkeypatch):
    """Every second peak of a chain is kept; each two took a round before."""
    written = []
    plain = seeds.saved
    monkeypatch.setattr(seeds, "saved", lambda df, name="stage": written.append(name) or plain(df, name))
    rows = [(z, 0, 0, z + 1, 1.0) for z in range(100)]
    found = seeds.spaced_peaks(spark.createDataFrame(rows, "z int, y int, x int, index_ long, v double"), "v", 1)
    assert sorted(r.z for r in found.collect()) == list(range(0, 100, 2))
    assert len(written) <= 4
