"""Distances to chosen vectors over tiles, and the farthest part, against plain loops."""

from __future__ import annotations

import numpy as np
import pytest

from stratovox.operators import selection


@pytest.mark.parametrize("asked, chosen", [(1 << 15, 1 << 13), (40, 7)])
def test_tiles_give_the_nearest(spark, asked, chosen, monkeypatch):
    monkeypatch.setattr(selection, "ASKED", asked)
    monkeypatch.setattr(selection, "CHOSEN", chosen)
    r = np.random.default_rng(1)
    a, b = r.normal(0, 1, (130, 6)), r.normal(0, 1, (25, 6))
    frame = lambda x: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "k long, v array<double>")
    got = {r.k: r.d for r in selection.nearest_distances(frame(a), frame(b), "k", "v").collect()}
    assert got == {i: pytest.approx(((v - b) ** 2).sum(axis=1).min()) for i, v in enumerate(a)}
    assert selection.nearest_distances(frame(a), frame(b).limit(0), "k", "v").count() == 0


def test_farthest_part_and_ties(spark):
    rows = spark.createDataFrame([(k, float(k // 3)) for k in range(20)], "k long, d double")
    got = [r.k for r in selection.farthest(rows, "k", "d", 5, 2).orderBy("k").collect()]
    assert got == [15, 16, 18, 19]
