"""Importance resampling against a plain loop, its CRC matrices, and the defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from stratovox.llm import queries, resampling
from stratovox.llm.decontaminate import NORMAL
from stratovox.llm.words import split_words
from tests.compare import same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, resampling string, weight string"


def features(text, ngrams):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [" ".join(words[i : i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, ngrams=1, buckets=10_000, min_words=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for table, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text, ngrams)[1]:
                table[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        words, own = features(text, ngrams)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= min_words))
    order = sorted((k for k in range(len(out)) if out[k][4]), key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    rank = {k: r + 1 for r, k in enumerate(order[: percent * len(order) // 100])}
    return sorted([(*x[:4], rank.get(k)) for k, x in enumerate(out)], key=repr)


def corpus(seed, n=300):
    r = random.Random(seed)
    vocabulary = ["The", "Über", "naïve", "x1", "z" * 3000, "q" * 2048, "q" * 2049] + [f"w{i}" for i in range(90)]
    docs = [(i, " ".join(r.choice(vocabulary[7:] if r.random() < 0.97 else vocabulary) + r.choice([" ", ", ", "\n"]) for _ in range(r.randrange(0, 60)))) for i in range(n)]
    docs += [(None, docs[7][1]), (901, None), (902, ""), (903, "?!"), (7, docs[7][1]), (904, "w1 " * 40_000)]
    return docs, [" ".join(r.choice(vocabulary[20:50]) for _ in range(30)) for _ in range(20)] + [None, ""]


def run(spark, docs, target, **options):
    d = spark.createDataFrame([(i, t, "r", "w") for i, t in docs], DOCS)
    found, name = resampling.resampled(d, spark.createDataFrame([(t,) for t in target], "text string"), **options)
    assert found.columns == [*d.columns, name]
    return sorted([(r["doc_id"], *(r[name][c] for c in ("n_features", "weight", "score", "rank"))) for r in found.collect()], key=repr)


@pytest.mark.parametrize("options", [{}, {"ngrams": 2, "buckets": 97, "min_words": 5, "percent": 50}, {"percent": 100, "min_words": 0}, {"percent": 0}])
def test_ranks_equal_a_plain_loop(spark, options):
    docs, target = corpus(1)
    assert run(spark, docs, target, **options) == brute(docs, target, **options)


def test_empty_tables(spark):
    docs, target = corpus(2, 40)
    assert run(spark, [], target) == []
    assert run(spark, docs, []) == brute(docs, [])


def test_drawn_documents_keep_their_columns(spark):
    docs, target = corpus(3, 100)
    d = spark.createDataFrame([(i, t, "r", "w") for i, t in docs], DOCS)
    got = resampling.drawn(d, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((i, dict(docs)[i]) for i, *_, rank in brute(docs, target) if rank)


def test_crcs_of_rows():
    r = np.random.default_rng(1)
    for size in (1, 2, 7, 64):
        rows = r.integers(0, 256, (50, size), dtype=np.uint8)
        assert resampling.crcs(rows).tolist() == [zlib.crc32(x.tobytes()) for x in rows]


def test_buckets_are_scattered_back_to_their_features():
    words = split_words(pa.array(["b a b", None, "ccc a", ""]), NORMAL)
    found, text = resampling.feature_buckets(words, 2, 1 << 20)
    want = [zlib.crc32(f) % (1 << 20) for f in (b"b", b"a", b"b", b"ccc", b"a", b"b a", b"a b", b"ccc a")]
    assert found.tolist() == want and text.tolist() == [0, 0, 0, 2, 2, 0, 0, 2]


def test_number_of_buckets_is_bounded(spark):
    docs, target = corpus(4, 20)
    with pytest.raises(ValueError):
        run(spark, docs, target, buckets=1 << 21)


def test_query_equals_sql(spark, data):
    same(queries.QUERIES["op12_resampling"](spark, data), queries.ORACLE_SQL["op12_resampling"], data)
