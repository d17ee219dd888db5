"""The Kneser-Ney model against its definition, written out with dictionaries."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from stratovox.llm import language_model as lm


def tokens(text):
    return [*(text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split(), None]


def brute(train):
    pairs = Counter()
    for text in train:
        before = "start"
        for word in tokens(text):
            pairs[before, word] += 1
            before = word
    count, seen, after = Counter(), Counter(), defaultdict(lambda: [0, 0, 0, 0])
    for (v, w), n in pairs.items():
        count[w] += n
        seen[w] += 1
        after[v][min(n, 3) - 1] += 1
        after[v][3] += n

    def discount(values):
        return lm.discounts([sum(v == k for v in values) for k in (1, 2, 3, 4)])

    high, low = discount(list(pairs.values())), discount(list(seen.values()))
    free = sum(low[min(n, 3)] for n in seen.values()) / max(1, len(pairs))

    def p(v, w):
        one = (seen[w] - low[min(seen[w], 3)]) / len(pairs) + free / (len(count) + 1)
        if v not in after:
            return one
        a, n = after[v], pairs[v, w]
        return (n - high[min(n, 3)]) / a[3] + (high[1] * a[0] + high[2] * a[1] + high[3] * a[2]) / a[3] * one

    return p, count


@pytest.mark.parametrize("shards", [512, 4])
def test_scores_equal_definition(spark, shards):
    r = random.Random(4)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(4000)]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 60))) for _ in range(150)] + ["", None, "UNSEEN words é", "w1 W1 w1"]
    train = texts[:120]
    p, count = brute(train)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.train(docs.where("doc_id < 120"), shards=shards)
    total = sum(count.values())
    assert (model.tokens, model.words) == (total, len(count))
    rows = {x.id: x for x in lm.scored(docs, model).collect()}
    for i, text in enumerate(texts):
        score, base, before = 0.0, 0.0, "start"
        for w in tokens(text):
            score += math.log10(p(before, w))
            base += math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1)))
            before = w
        assert rows[i].n_tokens == len(tokens(text)) and rows[i].n_known == sum(count[w] > 0 for w in tokens(text))
        assert rows[i].score == pytest.approx(score, rel=1e-9) and rows[i].base_score == pytest.approx(base, rel=1e-9)
    vocabulary = [*count, "never"]
    assert sum(p("start", w) for w in vocabulary) == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = lm.train(none)
    row = lm.scored(spark.createDataFrame([(None, "a b")], "doc_id long, text string"), model).first()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)
    assert lm.scored(none, model).count() == 0
