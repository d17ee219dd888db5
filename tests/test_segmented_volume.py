"""Segmentation of a whole volume: basins touch as the voxels say, whatever the blocks."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from stratovox.operators import agglomeration, regions, watershed

AFFINITIES = {a: f"a{a}" for a in "zyx"}


def volume(spark, levels=5, holes=0.15):
    r = random.Random(levels)
    rows = [(z, y, x, *(None if r.random() < 0.1 else math.floor(r.random() * levels) / levels for _ in range(3)))
            for z in range(7) for y in range(9) for x in range(10) if r.random() >= holes]
    return spark.createDataFrame(rows, "z int, y int, x int, az double, ay double, ax double")


@pytest.mark.parametrize("side", [4, 32])
def test_touching_parts_give_the_edges_of_the_basins(spark, side):
    v = volume(spark)
    parts, roots, touching = watershed.basin_parts(v, AFFINITIES, 0.2, 0.8, side=side, edges=True)
    basins = watershed.named_parts(parts, roots).withColumnRenamed("id", "basin")
    rows = basins.join(v, ["z", "y", "x"])
    want = {(r.u, r.v): (r.low, r.high, round(r.total, 9), r.faces) for r in agglomeration.region_edges(regions.faces(rows, "basin", AFFINITIES)).collect()}
    found = agglomeration.relabelled(touching, roots.select(F.col("node").alias("id"), F.col("root").alias("rep")))
    assert {(r.u, r.v): (r.low, r.high, round(r.total, 9), r.faces) for r in found.collect()} == want and len(want) > 20


@pytest.mark.parametrize("how, threshold", [("max", 0.5), ("mean", 0.45)])
def test_small_blocks_give_what_one_block_gives(spark, how, threshold):
    v = volume(spark)
    got, want = ({(r.z, r.y, r.x): r.id for r in agglomeration.segmented_volume(v, AFFINITIES, threshold, how, 0.2, 0.8, side=side).collect()} for side in (4, 32))
    assert got == want and len(want) == v.count() and len(set(want.values())) > 3


def test_nan_is_the_greatest_affinity_and_no_open_edge(spark):
    rows = [(0, 0, 0, 0.1), (0, 0, 1, 0.9), (0, 0, 2, float("nan")), (0, 0, 3, 0.9)]
    v = spark.createDataFrame(rows, "z int, y int, x int, a double").withColumn("b", F.lit(0.0))
    _, _, touching = watershed.basin_parts(v, {"z": "b", "y": "b", "x": "a"}, edges=True)
    assert touching.count() == 0  # all in one basin
    parts, roots, touching = watershed.basin_parts(v.withColumn("a", F.expr("if(x = 2, 0.5d, a)")), {"z": "b", "y": "b", "x": "a"}, edges=True)
    assert [(r.u, r.v, r.low, r.high, r.faces) for r in touching.collect()] == [(1, 3, 0.5, 0.5, 1)]


def test_merging_shuffles_no_voxels(spark, monkeypatch):
    """The edges come from blocks: no window over voxels, and voxels aren't joined before they get their last names."""
    plans, kept = [], agglomeration.saved
    monkeypatch.setattr(agglomeration, "saved", lambda df, name="stage": plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or kept(df, name))
    found = agglomeration.segmented_volume(volume(spark), AFFINITIES, 0.5, "max", 0.2, 0.8)
    assert "edges" in [name for name, _ in plans]
    assert not any("Window" in plan for _, plan in plans) and "Window" not in found._jdf.queryExecution().executedPlan().toString()
