"""Seeded samples, and chunked stores, against plain loops; readers and writers of volumes."""

from __future__ import annotations

import gzip
import json
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratovox.operators import augment, regions, sampling
from stratovox.sources import chunks, volumes
from tests.test_operators import as_dict


def table(spark, sizes):
    return spark.createDataFrame(sizes, "volume string, nz int, ny int, nx int")


def test_draws_follow_the_shares_of_windows(spark):
    sizes = [("a", 4, 9, 9), ("b", 4, 5, 5), ("c", 1, 50, 50)]  # 3 * 4 * 4 and 3 * 2 * 2 windows, and none
    found = sampling.window_draws(table(spark, sizes), (2, 3, 3), (1, 2, 2), 3000, 1)
    rows = found.collect()
    share = Counter(r.volume for r in rows)
    assert len(rows) == 3000 and abs(share["a"] / 3000 - 0.8) < 0.03 and not share["c"]
    places = Counter((r.z, r.y, r.x) for r in rows if r.volume == "a")
    assert set(places) == {(z, y, x) for z in range(3) for y in (0, 2, 4, 6) for x in (0, 2, 4, 6)}
    assert max(places.values()) < 100 and min(places.values()) > 20
    again = sampling.window_draws(table(spark, sizes).repartition(7), (2, 3, 3), (1, 2, 2), 3000, 1).repartition(5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    other = sampling.window_draws(table(spark, sizes), (2, 3, 3), (1, 2, 2), 3000, 2).collect()
    assert sorted(map(tuple, other)) != sorted(map(tuple, rows))
    assert sampling.window_draws(table(spark, sizes).limit(0), (2, 3, 3), (1, 2, 2), 10, 1).count() == 0


def test_rejected_draws_are_drawn_again(spark):
    sizes = [("a", 1, 1, 10)]
    draws = sampling.window_draws(table(spark, sizes), (1, 1, 1), (1, 1, 1), 300, 5, 6)
    good = spark.createDataFrame([("a", 0, 0, x) for x in (1, 2, 2)], "volume string, z int, y int, x int")
    tried = {}
    for r in draws.collect():
        tried.setdefault(r.slot, {})[r["try"]] = r.x
    for r in sampling.first_accepted(draws, good).collect():
        hits = [k for k in range(6) if tried[r.slot][k] in (1, 2)]
        assert (r["try"], r.valid) == ((hits[0], True) if hits else (5, False)) and r.x == tried[r.slot][r["try"]]


def test_windows_with_enough_voxels(spark):
    r = np.random.default_rng(1)
    a = (r.random((3, 9, 10)) < 0.3).astype(int)
    v = spark.createDataFrame([(*map(int, p), int(a[p])) for p in np.ndindex(a.shape) if a[p]], "z int, y int, x int, v int")
    for window, stride in (((2, 3, 4), (1, 2, 3)), ((1, 2, 2), (2, 3, 4))):
        want = {p for p in np.ndindex(a.shape) if all(k % s == 0 for k, s in zip(p, stride)) and a[tuple(slice(k, k + w) for k, w in zip(p, window))].sum() >= 2}
        assert {(x.z, x.y, x.x) for x in sampling.all_in(v, "v", window, stride, 2).collect()} == want


def test_cycling_takes_all_before_any_again(spark):
    rows = spark.createDataFrame([(k,) for k in (3, 5, 8, 13, 21, 21)], "idx int")
    got = {r.step: r.idx for r in sampling.cycled(rows, "idx", 13, 4).collect()}
    assert sorted(got) == list(range(13))
    assert {got[k] for k in range(5)} == {got[k] for k in range(5, 10)} == {3, 5, 8, 13, 21} and len({got[k] for k in range(10, 13)}) == 3
    assert [got[k] for k in range(5)] != [got[k] for k in range(5, 10)]
    assert sampling.cycled(rows, "idx", 0, 4).count() == 0 == sampling.cycled(rows.limit(0), "idx", 5, 4).count()


def test_weighted_sample_follows_weights(spark):
    rows = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("w"))
    got = [r.k for r in sampling.weighted_sample(rows, ["k"], "w", 400, 9).collect()]
    assert len(set(got)) == 400 and 0.68 < sum(k % 2 == 0 for k in got) / 400 < 0.82
    assert sampling.weighted_sample(rows.withColumn("w", F.lit(0.0)), ["k"], "w", 5, 9).count() == 0


def store(spark, tmp_path, kind="uint64", compressed=True, shape=(5, 9, 10), chunk=(2, 4, 4), offset=(0, 0, 0)):
    a = np.arange(1, 1 + np.prod(shape)).reshape(shape)
    a[2:4, :4, :4] = 0  # one chunk without any voxel
    rows = [(*(int(k + o) for k, o in zip(p, offset)), int(a[p])) for p in np.ndindex(shape) if a[p]]
    v = spark.createDataFrame(rows, "z int, y int, x int, v long")
    n = chunks.write_chunks(v, str(tmp_path), "v", kind, chunk, shape, offset=offset, compressed=compressed)
    return a, n


@pytest.mark.parametrize("compressed, offset", [(True, (0, 0, 0)), (False, (10, 20, 30))])
def test_stores_are_read_as_they_were_written(spark, tmp_path, compressed, offset):
    a, n = store(spark, tmp_path, compressed=compressed, offset=offset)
    files = sorted(f for f in os.listdir(tmp_path / "0") if not f.startswith("."))
    assert n == len(files) == 3 * 3 * 3 - 1 and all(f.endswith(".gz") == compressed for f in files)
    low = f"{offset[2]}-{offset[2] + 4}_{offset[1]}-{offset[1] + 4}_{offset[0]}-{offset[0] + 2}"
    raw = (tmp_path / "0" / (low + (".gz" if compressed else ""))).read_bytes()
    assert np.frombuffer(gzip.decompress(raw) if compressed else raw, "<u8").reshape(2, 4, 4).tolist() == a[:2, :4, :4].tolist()
    got = as_dict(chunks.read_chunks(spark, str(tmp_path), background=True), "value")
    assert got == {tuple(k + o for k, o in zip(p, offset)): int(a[p]) for p in np.ndindex(a.shape)}
    sparse = as_dict(chunks.read_chunks(spark, str(tmp_path)), "value")
    assert len(sparse) == a.size - 32


def test_boxes_open_only_the_chunks_they_touch(spark, tmp_path):
    a, _ = store(spark, tmp_path)
    box = chunks.read_chunks(spark, str(tmp_path), low=(1, 5, 0), high=(2, 9, 5))
    assert box.rdd.getNumPartitions() == 1 * 2 * 2
    assert as_dict(box, "value") == {(1, y, x): int(a[1, y, x]) for y in range(5, 9) for x in range(5)}
    for name in os.listdir(tmp_path / "0"):  # what isn't touched can't be read any more
        if not name.startswith(("0-4_4-8_0-2", "4-8_4-8_0-2")):
            (tmp_path / "0" / name).write_bytes(b"broken")
    pushed = chunks.read_chunks(spark, str(tmp_path)).where("z < 2 and y >= 4 and y <= 7 and x < 8 and value > 0")
    assert as_dict(pushed, "value") == {(z, y, x): int(a[z, y, x]) for z in range(2) for y in range(4, 8) for x in range(8)}
    assert chunks.read_chunks(spark, str(tmp_path), low=(3, 0, 0), high=(3, 9, 9)).count() == 0


def test_channels_scales_and_copies(spark, tmp_path):
    rows = [(0, y, x, c, float(y * 10 + x + c / 4)) for y in range(3) for x in range(5) for c in range(2)]
    v = spark.createDataFrame(rows, "z int, y int, x int, c int, v double")
    path = str(tmp_path / "image")
    chunks.write_chunks(v, path, "v", "float32", (1, 2, 2), (1, 3, 5), channels=2)
    chunks.write_chunks(v.where("y = 0 and x < 2"), path, "v", "float32", (1, 2, 2), (1, 1, 2), channels=2, key="1", append=True)
    assert json.load(open(f"{path}/info"))["num_channels"] == 2 and len(chunks.read_info(path)["scales"]) == 2
    read = lambda p, mip=0: sorted(tuple(r) for r in chunks.read_chunks(spark, p, mip).collect())
    assert read(path) == rows and read(path, 1) == [r for r in rows if r[1] == 0 and r[2] < 2]
    chunks.converted(spark, path, str(tmp_path / "copy"), (1, 3, 4))
    assert read(str(tmp_path / "copy")) == rows and len(os.listdir(tmp_path / "copy" / "0")) == 2


def test_stores_refuse_what_they_cannot_hold(spark, tmp_path):
    v = spark.createDataFrame([(0, 0, 9, 1)], "z int, y int, x int, v long")
    with pytest.raises(Exception, match="outside of the store"):
        chunks.write_chunks(v, str(tmp_path / "a"), "v", "uint8", (1, 2, 2), (1, 2, 4))
    with pytest.raises(ValueError, match="mounted"):
        chunks.read_info("s3://bucket/volume")


@pytest.mark.parametrize("suffix", ["parquet", "orc", "json", "csv"])
def test_volumes_are_read_by_suffix(spark, tmp_path, suffix):
    v = spark.createDataFrame([(z, y, x, z * 10 + y + x) for z in range(3) for y in range(2) for x in range(2)], "z int, y int, x int, v int")
    path = f"{tmp_path}/volume.{suffix}"
    volumes.write_volume(v, path)
    schema = "z int, y int, x int, v int"
    assert as_dict(volumes.read_volume(spark, path, schema), "v") == as_dict(v, "v")
    volumes.write_volume(v, f"{tmp_path}/preview.{suffix}", slices=2)
    assert as_dict(volumes.read_volume(spark, f"{tmp_path}/preview.{suffix}", schema), "v") == as_dict(v.where("z < 2"), "v")


def test_channels_are_averaged_when_a_volume_is_read(spark, tmp_path):
    v = spark.createDataFrame([(0, 0, 0, 0, 1.0), (0, 0, 0, 1, 2.0), (0, 0, 1, 0, 5.0)], "z int, y int, x int, c int, v double")
    v.write.parquet(f"{tmp_path}/v.parquet")
    assert as_dict(volumes.read_volume(spark, f"{tmp_path}/v.parquet", drop_channel="v"), "v") == {(0, 0, 0): 1.5, (0, 0, 1): 5.0}


def test_lists_of_files_and_stacks(spark, tmp_path):
    for k in (2, 0, 1):
        (tmp_path / f"s{k}.png").write_bytes(bytes([k]))
    (tmp_path / "other.tif").write_bytes(b"t")
    got = [p.rsplit("/", 1)[-1] for p in volumes.listed_paths(spark, f"{tmp_path}/other.tif@{tmp_path}/s*.png@{tmp_path}/none*")]
    assert got == ["other.tif", "s0.png", "s1.png", "s2.png"]
    stack = volumes.image_stack(spark, f"{tmp_path}/s*.png").orderBy("z").collect()
    assert [(r.z, bytes(r.content)) for r in stack] == [(0, bytes([0])), (1, bytes([1])), (2, bytes([2]))]


def test_random_scores_depend_on_edge_and_seed(spark):
    e = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "u long, v long")
    one = {(r.u, r.v): r.s for r in e.select("u", "v", regions.random_score(1).alias("s")).collect()}
    same = {(r.u, r.v): r.s for r in e.repartition(3).select("u", "v", regions.random_score(1).alias("s")).collect()}
    two = {(r.u, r.v): r.s for r in e.select("u", "v", regions.random_score(2).alias("s")).collect()}
    assert one == same and one != two and len(set(one.values())) == 3 and all(0 <= s < 1 for s in one.values())


def test_names_of_tiles():
    assert augment.tile_names(3, "im{z}.png") == ["im0.png", "im1.png", "im2.png"]
    assert augment.tile_names(12, "{z}")[1] == "01" and augment.tile_names(0, "{z}") == []
