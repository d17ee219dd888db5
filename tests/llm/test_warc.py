"""WARC files: round trips, normalising, and the query against its SQL."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from stratovox.llm import queries, warc
from stratovox.llm.common import shared_folder
from tests.compare import same


def test_query_equals_sql(spark, data):
    same(queries.op6_warc(spark, data), queries.ORACLE_SQL["op6_warc"], data)


@pytest.mark.parametrize("members", [1, 3])
def test_normalised_file_holds_one_member_a_record(tmp_path, members):
    records = [warc.record(i, f"http://a/{i}", f"payload {i}\r\n\r\n".encode() * (i * 3000), None, False) for i in range(6)]
    source, target = tmp_path / "in.gz", tmp_path / "out.gz"
    step = -(-len(records) // members)
    source.write_bytes(b"".join(gzip.compress(b"".join(records[i : i + step])) for i in range(0, 6, step)))
    entries = warc.normalise(str(source), str(target))
    data = target.read_bytes()
    assert [gzip.decompress(data[e.offset : e.offset + e.length]) for e in entries] == records
    assert gzip.decompress(data) == b"".join(records)
    assert (tmp_path / "out.gz.idx").read_text().splitlines() == [f"{e.offset} {e.length} response <urn:x-page:{i}> http://a/{i}" for i, e in enumerate(entries)]


def test_truncated_files_are_refused(tmp_path):
    (tmp_path / "bad.gz").write_bytes(gzip.compress(warc.record(1, None, b"x" * 100, None, False)[:-60]))
    with pytest.raises(ValueError):
        warc.normalise(str(tmp_path / "bad.gz"), str(tmp_path / "out.gz"))


def test_defined_cases(spark):
    rows = [(1, "u", "same"), (2, "u\r\nX: y", "same"), (2, "u\r\nX: y", "same"), (3, None, None), (4, "", ""), (None, "v", "same"), (None, "v", "alone"), (7, "w", "é" * 50_000)]
    pages = spark.createDataFrame([(*r, 5, "k") for r in rows], "page_id long, url string, html string, payload long, sha string")
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    kinds = sorted(((r.id or 0), r.kind, r.refers_to or 0, r.payload_bytes) for r in found)
    assert kinds == sorted([(1, "revisit", 2, 4), (2, "response", 0, 4), (2, "response", 0, 4), (3, "revisit", 4, 0), (4, "response", 0, 0), (0, "revisit", 2, 4), (0, "response", 0, 5), (7, "response", 0, 100_000)])
    big = next(r for r in found if r.id == 7)
    assert bytes(big.payload) == ("é" * 50_000).encode() and big.digest == warc.base32_sha1(bytes(big.payload))
    assert all(r.payload is None for r in found if r.kind == "revisit")
    assert warc.round_trip(pages.limit(0)).count() == 0
    few = warc.round_trip(pages, min_bytes=5).collect()
    assert {r.kind for r in few} == {"response"}


def test_rewriting_again_after_a_lost_task(spark):
    pages = spark.createDataFrame([(i, "u", f"text {i % 3}") for i in range(9)], "page_id long, url string, html string")
    a, b = (shared_folder(spark, "again") for _ in range(2))
    archives = warc.write(warc.planned(pages), a)
    first = sorted(map(tuple, warc.normalised(archives, b, remove_source=True).collect()))
    assert sorted(map(tuple, warc.normalised(archives, b, remove_source=True).collect())) == first


def test_a_folder_that_nodes_do_not_share_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    with pytest.raises(Exception, match="driver's folder"):
        warc.write(warc.planned(pages), f"file://{tmp_path}/elsewhere")


def test_digest():
    assert warc.base32_sha1(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and hashlib.sha1(b"").hexdigest().startswith("da39")
