"""SimHash groups against brute force, and the defined cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from stratovox.llm import buckets, groups, simhash

DOCS = "doc_id long, text string, extra string, fp long, id string"


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, linked):
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def corpus(n=120, seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        if texts and r.random() < 0.5:
            words = r.choice(texts).split()
            for _ in range(r.randrange(0, 4)):
                if words:
                    words[r.randrange(len(words))] = r.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(r.choice(vocabulary) for _ in range(r.randrange(0, 120))))
    return {i: t for i, t in enumerate(texts)}


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 7, "y") for i, t in texts.items()], DOCS)


def test_groups_equal_brute_force(spark):
    texts = corpus()
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(list(texts), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    got = {r.id: (r.fp % 2**64, r.component) for r in simhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == {i: (fps[i], want[i]) for i in texts}


def test_whole_long_text_counts(spark):
    text = " ".join(f"word{i}" for i in range(40_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, "A B C D"), (7, "é x")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    by_id = {r.id: r for r in found}
    assert {by_id[i].fp for i in (1, 2, 3)} == {0} and {by_id[i].component for i in (1, 2, 3)} == {1}
    assert by_id[None].component == by_id[5].component == by_id[6].component == 5
    assert by_id[7].component == 7
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def jaccard(a, b):
    a, b = (set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in (a, b))
    shared = len(a & b)
    return shared >= 0.8 * (len(a) + len(b) - shared)


@pytest.mark.parametrize("chunk", [512, 2])
def test_copies_leave_one_of_each_group(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    texts = corpus(90, 2)
    want = brute_components(list(texts), lambda a, b: jaccard(texts[a], texts[b]))
    left = simhash.without_copies(frame(spark, texts))
    assert left.columns == ["doc_id", "text", "extra", "fp", "id"]
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_copies_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (4, "x y z"), (4, "x y z"), (5, "x y z")]
    left = simhash.without_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left if r.text is not None) == [(0, "a b"), (0, "a b"), (4, "x y z")]
    assert [r.doc_id for r in left if r.text is None] == [1]
    assert simhash.without_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_different_texts_of_one_id_all_stay(spark):
    rows = [(1, "one text of its own"), (1, "and quite another one"), (1, "and quite another one"), (2, "a third")]
    left = simhash.without_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, "and quite another one"), (1, "one text of its own"), (2, "a third")]


@pytest.mark.parametrize("chunk", [4096, 3])
def test_recall_of_candidates_against_all_pairs(spark, monkeypatch, chunk):
    """Copies edited in four ways down to a similarity of 0.8: candidate components hold at least 0.98 of all linked pairs."""
    monkeypatch.setattr(buckets, "CHUNK", chunk)
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(220):
        words = [r.choice(vocabulary) for _ in range(r.randrange(30, 400))]
        n, copy = len(words), list(words)
        how = r.randrange(4)
        if how == 0:  # scattered words
            for k in r.sample(range(n), max(1, n // 60)):
                copy[k] = "x"
        elif how == 1:  # a passage appended
            copy += [r.choice(vocabulary) for _ in range(n // 5)]
        elif how == 2:  # a block replaced
            copy[n // 3 : n // 3 + n // 12] = [r.choice(vocabulary) for _ in range(n // 12)]
        else:  # the end cut off
            copy = copy[: n - n // 6]
        texts += [" ".join(words), " ".join(copy)]
    pairs = [(a, a + 1) for a in range(0, len(texts), 2) if jaccard(texts[a], texts[a + 1])]
    assert len(pairs) > 150
    rows = [(i, simhash.fingerprint(t.encode()), simhash.sketch(simhash.shingle_hashes(t.encode(), 5))) for i, t in enumerate(texts)]
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f, bytearray(s)) for i, f, s in rows], "id long, fp long, sketch binary")
    linked = {tuple(sorted((x.a, x.b))) for x in simhash.candidate_links(nodes).collect()}
    assert sum(p in linked for p in pairs) >= 0.98 * len(pairs)


def test_recall_of_groups_on_the_documents(spark):
    """All pairs of the 0.01 tables with a similarity of 0.8 or more, by an exact join on shared shingles, end in one group."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets = {i: set(simhash.shingle_hashes((t or "").encode(), 5).tolist()) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() if len(ids) < 200 for a in ids for b in ids if a < b}
    linked = [(a, b) for a, b in pairs if (k := len(sets[a] & sets[b])) >= 0.8 * (len(sets[a]) + len(sets[b]) - k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r.doc: (r.keeper_doc, r.keeper_id) for r in simhash.similar_groups(docs).collect()}
    assert linked and sum(group[a] == group[b] for a, b in linked) >= 0.99 * len(linked)


def test_groups_module_links_across_chunks(spark):
    rows = spark.createDataFrame([(1, 40, i, i) for i in range(40)], "g long, n long, id long, value long")

    def near(run):
        v = run.column("value").to_pylist()
        return lambda i, later: (later, np.zeros(len(later))), lambda i, j: abs(v[i] - v[j]) == 1

    from stratovox.llm.common import saved

    found = groups.linked_groups(saved(rows), near, ["value"], 6)
    assert {r.id: r.root for r in found.collect()} == {i: 0 for i in range(1, 40)}
