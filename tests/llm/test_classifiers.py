"""Held-out accuracy of both classifiers, and the defined cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from stratovox.llm import queries, quality, toxicity

BIG = "/root/testdata/sf0.1"


def accuracy(spark, name, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, BIG).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    caught = np.mean([p == 1 for y, p in held if y == 1])
    spared = np.mean([p == 0 for y, p in held if y == 0])
    return len(rows), caught, spared


def test_quality_on_the_held_out_fold(spark):
    n, caught, spared = accuracy(spark, "op10_quality", "quality")
    assert n == 10_000 and caught > 0.98 and spared > 0.95


def test_toxicity_on_the_held_out_fold(spark):
    n, caught, spared = accuracy(spark, "op9_toxicity", "toxic")
    assert n == 10_000 and caught > 0.85 and spared > 0.97


def test_trees_equal_a_plain_walk():
    r = np.random.default_rng(1)
    x = r.standard_normal((800, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.grow(x, y, trees=30, depth=3)
    score = trees.score(x)
    assert ((score > 0.5) == y).mean() > 0.97
    for i in range(0, 800, 97):
        total = trees.base
        for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(x[i, feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert score[i] == pytest.approx(1 / (1 + np.exp(-total)))


@pytest.mark.parametrize("module", [quality, toxicity])
def test_defined_cases(spark, module):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "", 5), (None, "some text", 5)], "doc_id long, text string, y int")
    column = "quality" if module is quality else "toxic"
    for rows in ([], [(1, 1), (2, 1)], [(None, 1), (1, None)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {column} int")
        model = module.fit(docs, labels)
        found = module.scored(docs, model)
        assert found.columns == ["doc_id", "text", "y", "score"]
        assert len({r.score for r in found.collect()}) == 1
    assert module.scored(docs.limit(0), model).count() == 0


def kernel(a, b):
    """The kernel by its definition: all quadruples of letters within the span."""
    from itertools import combinations

    def vector(token):
        codes, out = toxicity.letters(token).tolist(), {}
        for places in combinations(range(len(codes)), 4):
            if places[-1] - places[0] < toxicity.SPAN:
                key = tuple(codes[p] for p in places)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (places[-1] - places[0] - 3)
        return out

    a, b = vector(a), vector(b)
    return sum(v * b.get(k, 0) for k, v in a.items()) / (sum(v * v for v in a.values()) * sum(v * v for v in b.values())) ** 0.5


def test_subsequence_vectors_equal_the_kernel():
    for a, b in (("idiot", "idxiot"), ("idiot", "i.d-i o.t".replace(" ", "")), ("banana", "bananana"), ("abcde", "vwxyz")):
        u, v = toxicity.vector(a), toxicity.vector(b)
        assert sum(w * v.get(k, 0) for k, w in u.items()) == pytest.approx(kernel(a, b))
        numbers, weight = toxicity.vectors(toxicity.letters(a)[None, :])
        assert toxicity._norms(numbers, weight)[0] ** 2 == pytest.approx(sum(x * x for x in _sums(a).values()))


def _sums(token):
    out = {}
    numbers, weight = toxicity.vectors(toxicity.letters(token)[None, :])
    for n, w in zip(numbers[0].tolist(), weight.tolist()):
        out[n] = out.get(n, 0) + w
    return out


def test_disguised_insults_keep_a_high_margin():
    bad = ["idiot", "moron", "scumbag", "loser", "pathetic"]
    good = ["island", "morning", "scholar", "lessons", "pattern", "idea", "riot", "table", "window", "garden", "music", "river"]
    machine = toxicity.nystroem_machine(bad + [v for w in bad for v in toxicity.disguised(w)], good)
    assert (machine.margins(["id-iot", "i.d.i.o.t", "idiiot", "morxon", "patheetic"]) > 0).all()
    assert (machine.margins(good) < 0).all()
    assert "idiot" in toxicity.tokens("you i d i o t there") and machine.margins(["a", ""]).tolist() == [toxicity.FLOOR] * 2


def small(spark):
    bad = ["you are an idiot and a moron, really.", "what a loser. pathetic!", "the m-o-r-o-n said so.", "idiot loser moron pathetic"]
    good = ["the island had a garden and a window.", "music by the river, in the morning. fine.", "a table of lessons", "scholars read patterns"]
    rows = [(i, f"{(bad if i % 3 == 0 else good)[i % 4]}\nline {i % 7} of {i % 5} words.") for i in range(120)]
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "x y"), (903, "Idiot! " * 300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 != 0)) for i in range(120)], "doc_id long, toxic int, quality int")
    return docs, labels


def test_toxicity_scores_equal_a_plain_implementation(spark):
    docs, labels = small(spark)
    machine = toxicity.fit(docs, labels)
    weight = dict(zip(machine.numbers.tolist(), machine.weights.tolist()))

    def margin(token):
        codes, best = toxicity.letters(token), toxicity.FLOOR
        for i in range(0, max(1, len(codes) - toxicity.LONG // 2), toxicity.LONG // 2):
            part, sums = codes[i : i + toxicity.LONG], {}
            if len(part) < 4:
                continue
            numbers, w = toxicity.vectors(part[None, :])
            for n, v in zip(numbers[0].tolist(), w.tolist()):
                sums[n] = sums.get(n, 0) + v
            norm = max(1e-9, sum(v * v for v in sums.values()) ** 0.5)
            best = max(best, sum(v * weight.get(n, 0) for n, v in sums.items()) / norm + machine.offset)
        return best

    for r in toxicity.scored(docs, machine).collect():
        margins = sorted((margin(w) for w in set(toxicity.tokens(r.text))), reverse=True)
        x = [*(max(toxicity.FLOOR, m) for m in margins[:3]), *[toxicity.FLOOR] * (3 - len(margins)), np.log1p(sum(m > 0 for m in margins)), np.log1p(len(margins))]
        want = 1 / (1 + np.exp(-(np.dot(x, machine.curve[:-1]) + machine.curve[-1])))
        assert r.score == pytest.approx(want, rel=1e-6)
        if r.doc_id < 120:
            assert (r.score >= 0.5) == (r.doc_id % 3 == 0)


def test_quality_scores_equal_a_plain_walk(spark):
    docs, labels = small(spark)
    trees = quality.fit(docs, labels)
    assert len(trees.feature)
    for r in quality.scored(docs, trees).collect():
        x, total = quality.statistics(r.text.encode() if r.text else None), trees.base
        for feature, threshold, value in zip(trees.feature.tolist(), trees.threshold.tolist(), trees.value.tolist()):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(x[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(total, -30, 30))))
