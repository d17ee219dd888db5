"""Links between groups whose members fill each other's neighbour lists."""

from __future__ import annotations

import numpy as np

from stratovox.llm import neighbours
from tests.llm.test_neighbours import brute


def test_links_between_saturated_groups(spark):
    r = np.random.default_rng(4)
    rows = []
    for _ in range(3):
        centre = r.standard_normal(16)
        aside = r.standard_normal(16)
        aside -= (aside @ centre) / (centre @ centre) * centre
        aside *= 0.17 * np.linalg.norm(centre) / np.linalg.norm(aside)
        for middle in (centre, centre + aside):
            rows += [(len(rows) + i, (middle + 0.004 * r.standard_normal(16)).tolist(), 1) for i in range(20)]
    found, _ = neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    want = brute(rows)
    assert len({c for _, c in want.values()}) == 3
    assert {x.id: (x.n_links, x.component) for x in found.collect()} == want
