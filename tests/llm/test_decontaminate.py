"""Decontamination against its SQL, a direct scan, and the defined cases."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from stratovox.llm import decontaminate, queries
from tests.compare import same


def test_query_equals_sql(spark, data):
    same(queries.op3_decontaminate(spark, data), queries.ORACLE_SQL["op3_decontaminate"], data)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items):
    found, hit, ids = words(text), set(), set()
    for item, other in items:
        grams = words(other)
        n = min(13, len(grams))
        windows = {tuple(grams[i : i + n]) for i in range(len(grams) - n + 1)} if n else set()
        for i in range(len(found) - n + 1) if n else ():
            if tuple(found[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                ids |= {str(item)} - {"None"}
    return len(found), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def sample():
    r = random.Random(6)
    w = [f"t{i}" for i in range(40)] + ["Straße", "été"]
    items = [(i, " ".join(r.choice(w) for _ in range(r.choice([0, 1, 5, 13, 20, 30])))) for i in range(12)] + [(3, "t1 t2"), (None, "t3")]
    docs = []
    for i in range(60):
        parts = [r.choice(w) for _ in range(r.randrange(0, 60))]
        if r.random() < 0.6:
            item = r.choice(items)[1].split()
            parts[len(parts) // 2 : len(parts) // 2] = item[: r.randrange(1, 40)]
        docs.append((i, r.choice([" ", ", ", "-"]).join(parts)))
    return docs + [(60, None), (61, ""), (61, "")], items


@pytest.mark.parametrize("limit", [1 << 20, 100])
def test_one_and_several_passes_equal_brute_force(spark, limit):
    docs, items = sample()
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.digest(*frames, broadcast_bytes=limit).collect())
    assert got == sorted((i, *brute(t, items)) for i, t in docs)


def test_documents_are_dropped_or_cut(spark):
    docs, items = sample()
    frames = spark.createDataFrame([(i, t, 5, "n") for i, t in docs], "doc_id long, text string, hits long, _hits string"), spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.dropped(*frames)
    assert kept.columns == ["doc_id", "text", "hits", "_hits"]
    want = [i for i, t in docs for n, hit, *_ in [brute(t, items)] if not (hit and 20 * hit >= n)]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    for r in decontaminate.cut(*frames).collect():
        before = dict(docs)[r.doc_id]
        n, hit, *_ = brute(before, items)
        assert (r.text is None) == (before is None)
        if before is not None:
            assert len(words(r.text)) == n - hit and (hit or r.text == before)


def test_empty_tables(spark):
    none, nothing = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(none, nothing).count() == 0
    row = decontaminate.digest(spark.createDataFrame([(None, "a b")], "doc_id long, text string"), nothing).first()
    assert (row.n_words, row.n_hit, row.n_items) == (2, 0, 0)
