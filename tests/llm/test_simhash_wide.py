"""Near copies whose SimHashes lie far apart, against Jaccard similarity alone."""

from __future__ import annotations

import random

from stratovox.llm import simhash
from tests.llm.test_simhash import brute_fingerprint, jaccard


def test_copies_with_an_appended_passage(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(2000)]
    pairs = []
    for _ in range(600):
        words = [r.choice(vocabulary) for _ in range(r.randrange(30, 200))]
        a, b = " ".join(words), " ".join(words + [r.choice(vocabulary) for _ in range(len(words) // 5)])
        if jaccard(a, b) and (brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() > 13:
            pairs.append((a, b))
    assert len(pairs) >= 5
    texts = [t for pair in pairs for t in pair]
    left = simhash.without_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(x.doc_id for x in left.collect()) == list(range(0, len(texts), 2))
