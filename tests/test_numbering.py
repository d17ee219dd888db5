"""Running numbers of streamed blocks: a stopped and resumed stream gives the ids of an uninterrupted one."""

from __future__ import annotations

import json

import pytest

from stratovox.streaming import numbering

SCHEMA = "volume string, idx long, max_id long"


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps({"volume": v, "idx": i, "max_id": m}) for v, i, m in rows))


def ran(spark, tmp_path, source, name):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / source))
    numbering.run_numbering(stream, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))
    return sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / name)).select("volume", "idx", "offset", "max_id").collect()), key=repr)


FILES = [
    [("a", 1, 5), ("a", 0, 3), ("b", 0, 7)],
    [("a", 2, 0), ("a", 0, 3), ("b", 4, 1)],  # block 0 of a again
    [("b", 2, 2), ("a", 3, 4), ("a", 3, 6), (None, 1, 2), ("b", None, 9), ("b", 5, None)],
    [("a", 1, 5), ("a", 7, 1)],
]
WANT = [("a", 0, 0, 3), ("a", 1, 3, 5), ("a", 2, 8, 0), ("a", 3, 8, 6), ("a", 7, 14, 1), ("b", 0, 0, 7), ("b", 2, 8, 2), ("b", 4, 7, 1)]


def test_a_resumed_stream_goes_on(spark, tmp_path):
    for k, rows in enumerate(FILES):
        put(tmp_path / "all", f"f{k}", rows)
    whole = ran(spark, tmp_path, "all", "whole")
    assert [r for r in whole if r[0]] == WANT
    for k, rows in enumerate(FILES[:2]):
        put(tmp_path / "parts", f"f{k}", rows)
    first = ran(spark, tmp_path, "parts", "resumed")
    assert 0 < len(first) < len(whole)
    for k, rows in enumerate(FILES[2:], 2):
        put(tmp_path / "parts", f"f{k}", rows)
    assert ran(spark, tmp_path, "parts", "resumed") == whole
    assert ran(spark, tmp_path, "parts", "resumed") == whole  # nothing new, nothing doubled
