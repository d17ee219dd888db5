"""Ranked search against a plain ranking of all documents, and the defined cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stratovox.llm import queries, ranking
from tests.compare import same

DOCS = "doc_id long, text string, score long, rank string, id string"
ITEMS = "item_id long, text string, extra string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k=20):
    words = [(i, Counter(terms(t))) for i, t in docs]
    words = [(i, c) for i, c in words if c]
    n, total = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for i, c in words:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def corpus(seed, n=700):
    r = random.Random(seed)
    vocabulary = ["the", "of", "Über", "naïve", "x1", "2024"] + [f"w{i}" for i in range(400)]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    texts = [" ".join(r.choices(vocabulary, weights, k=r.randrange(0, 90))) for _ in range(n)]
    texts[3:40] = [texts[2]] * 37  # ties
    docs = [(i * 7 % 1000, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, texts[5]), (50, None), (51, ""), (52, "?! --"), (7, texts[9]), (7, texts[9]), (60, "the " * 5000 + "w1")]
    items = [(i, " ".join(r.choices(vocabulary, weights, k=r.randrange(1, 40)))) for i in range(12)] + [(90, None), (91, "..."), (92, "unknown-words only"), (93, texts[2]), (93, texts[2]), (None, "THE über")]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, 1, "r", "z") for i, t in docs], DOCS), spark.createDataFrame([(i, t, "e") for i, t in items], ITEMS)


def rows(found):
    return sorted([(r["item"], r["rank"], r["id"], r["score"]) for r in found.collect()], key=repr)


@pytest.mark.parametrize("shard_bytes", [3_000, ranking.SHARD_BYTES])
def test_ranks_equal_a_plain_ranking(spark, shard_bytes):
    docs, items = corpus(1)
    d, i = frames(spark, docs, items)
    got = rows(ranking.search(ranking.build(d, shard_bytes=shard_bytes), i))
    assert got == brute(docs, items)


def test_parts_of_queries_give_the_same(spark):
    docs, items = corpus(2, 150)
    d, i = frames(spark, docs, items)
    assert rows(ranking.search(ranking.build(d), i, k=3, query_bytes=600)) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(3, 20)
    d, i = frames(spark, docs, items)
    assert rows(ranking.search(ranking.build(d.limit(0)), i)) == []
    assert rows(ranking.search(ranking.build(d), i.limit(0))) == []
    assert rows(ranking.search(ranking.build(d.where("doc_id in (50, 51, 52)")), i)) == []


def test_non_essential_blocks_stay_compressed(spark):
    """A frequent term of little weight is only opened in blocks with candidates."""
    import pyarrow as pa

    texts = ["common"] * 60_000
    for at in range(0, 400, 20):
        texts[at] = "common rare rare rare"
    texts[59_000] = "common rare"
    batch = pa.array(texts)
    found = list(ranking._shard_rows(1, pa.array(range(len(texts))), ranking.split_words(batch, ranking.NORMAL), len(texts), len(texts) + 61))
    shard = ranking.Shard(pa.Table.from_batches(found))
    number = {w: ranking.term_number(w) for w in (b"common", b"rare")}
    most = {w: int(max(shard.most[a] for a in range(*shard.lists[number[w]]))) for w in number}
    docs, scores = ranking.best(shard, [(number[b"common"], 1, most[b"common"]), (number[b"rare"], 8000, most[b"rare"])], 20)
    assert docs.tolist() == list(range(0, 400, 20)) and (scores > 0).all()
    a, b = shard.lists[number[b"common"]]
    assert len([k for k in shard.open if a <= k < b]) < 10 < b - a


def test_packing_of_numbers():
    values = np.array([0, 1, 127, 128, 300, 1 << 14, (1 << 21) - 1, 1 << 40, 5], np.int64)
    assert ranking.unpacked(ranking.packed(values)[0]).tolist() == values.tolist()
    assert len(ranking.unpacked(ranking.packed(values[:0])[0])) == 0


def test_query_equals_sql(spark, data):
    same(queries.QUERIES["op11_ranking"](spark, data), queries.ORACLE_SQL["op11_ranking"], data)
