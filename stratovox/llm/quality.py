"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on a bounded sample of labelled rows (``sample``, a documented parameter) whose statistics
Spark computes; they are flattened into arrays and applied to batches of documents by numpy indexing, one
step a level. Only the text enters a score.

Defined cases: null and empty texts have all statistics zero and get the score of such a text; repeated
rows get equal scores; repeated labels of a document count as their mean; without labels, or with labels
of one class, every score is the smoothed share of that class; an empty table gives an empty result; other
columns are ignored or pass through.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratovox.llm.common import crc_bucket

#: Labelled rows that a classifier is fitted on at most.
SAMPLE = 20_000
BINS, DEPTH, TREES, RATE, LEAST = 64, 4, 120, 0.1, 12

_KIND = np.zeros(256, np.int64)  # 0 other, 1 small or non-ASCII letter, 2 capital, 3 digit, 4 white space, 5 continuation byte
_KIND[97:123] = 1
_KIND[192:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[128:192] = 5
_MARKS = (b"!", b"?", b".", b",", b"|", b"%", b"$", b"#", b"&", b"*", b"@", b"/", b":", b"=", b"-", b"<")
WIDTH = 21 + len(_MARKS)


def statistics(text: bytes | None) -> list[float]:
    """Statistics of a whole text: shares of characters, repetition of words and lines, lengths."""
    if not text:
        return [0.0] * WIDTH
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    other, small, capital, digit, white, more = np.bincount(_KIND, weights=seen, minlength=6)
    chars = len(text) - more
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    line_sizes = Counter(lines)
    ends = Counter(w[-1] for w in words)
    odd_ends = sum(v for k, v in ends.items() if not _KIND[k])
    return [
        float(np.log1p(chars)), (small + capital) / chars, capital / max(1, small + capital), digit / chars, white / chars, other / chars,
        float(np.log1p(len(words))), float(sizes.mean()) if len(words) else 0.0, float(sizes.std()) if len(words) else 0.0,
        len(counts) / n, max(counts.values(), default=0) / n, pairs / max(1, len(words) - 1), sum(a == b for a, b in zip(words, words[1:])) / n,
        float(np.log1p(len(lines))), len(line_sizes) / max(1, len(lines)), n / max(1, len(lines)),
        max((len(x) * k for x, k in line_sizes.items()), default=0) / len(text), odd_ends / n,
        float((sizes == 1).mean()) if len(words) else 0.0, float((sizes > 20).mean()) if len(words) else 0.0, sum(w.isupper() for w in counts) / max(1, len(counts)),
        *(int(seen[m[0]]) / n for m in _MARKS),
    ]


@dataclass
class Trees:
    """Complete binary trees of one depth as arrays: node i has children 2i+1 and 2i+2; the last level holds values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows, trees, inner = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :], self.feature.shape[1]
        if len(self.feature):
            node = np.zeros((len(x), len(self.feature)), np.int64)
            while node[0, 0] < inner if len(x) else False:
                node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
            total += self.value[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Fit boosted trees to labels 0..1 by logistic loss on binned columns."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 0.5) / (len(y) + 1)
    none = Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return none
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T)])  # value > cut k  <=>  bin > k
    feature, threshold, value = np.zeros((trees, inner), int), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    total = np.full(len(y), none.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gain, at, by = np.full(width, 1e-9), np.zeros(width, int), np.full(width, -1)
            for f, b in enumerate(binned):
                place = (node - first) * BINS + b
                sums = [np.bincount(place, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h, None)]
                (gl, hl, nl), (gt, ht, nt) = sums, [s[:, -1:] for s in sums]
                gr, hr, nr = gt - gl, ht - hl, nt - nl
                better = np.where((nl >= LEAST) & (nr >= LEAST), gl**2 / (hl + 1) + gr**2 / (hr + 1) - gt**2 / (ht + 1), 0)
                best = better.argmax(1)
                score = better[np.arange(width), best]
                up = score > gain
                gain[up], at[up], by[up] = score[up], best[up], f
            for k in range(width):
                if by[k] >= 0 and at[k] < len(cuts[by[k]]):
                    feature[t, first + k], threshold[t, first + k] = by[k], cuts[by[k]][at[k]]
            i = node
            node = 2 * i + 1 + (x[np.arange(len(y)), feature[t, i]] > threshold[t, i])
        leaf = node - inner
        value[t] = RATE * np.bincount(leaf, weights=g, minlength=leaves) / (np.bincount(leaf, weights=h, minlength=leaves) + 1)
        total += value[t][leaf]
    return Trees(feature, threshold, value, none.base)


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, folds: int, sample: int) -> DataFrame:
    """``(id, y, t)``: texts and mean labels of at most ``sample`` labelled documents outside the held-out fold.

    The sample has the least hashes of the ids; as it is bounded, it is broadcast and the documents aren't shuffled.
    """
    marks = (
        labels.where((crc_bucket(id_col, folds) != 0) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.avg(label_col).alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return texts.join(F.broadcast(marks), "id")


def _rows(batches):
    for batch in batches:
        stats = [statistics(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stats, pa.list_(pa.float64()))], names=["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, sample: int = SAMPLE) -> Trees:
    """Grow the trees on a bounded sample: rows whose crc32(id) modulo ``folds`` isn't 0."""
    found = labelled(docs, labels, label_col, id_col, text_col, folds, sample).select("y", "t").mapInArrow(_rows, "y double, x array<double>").toPandas()
    if not len(found):
        return grow(np.zeros((0, WIDTH)), np.zeros(0))
    found = found.sort_values(["y"], kind="stable")
    x, y = np.stack(found["x"].to_list()), found["y"].to_numpy()
    order = np.lexsort([*x.T, y])  # the same trees whatever the order of the rows
    return grow(x[order], y[order])


def scored(docs: DataFrame, model: Trees, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, in one pass without a shuffle. ``name`` must not be a column yet."""
    shipped, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def scan(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            stats = np.array([statistics(t.encode() if t else None) for t in texts]).reshape(-1, WIDTH)
            score = np.concatenate([shipped.value.score(stats[i : i + 1000]) for i in range(0, len(stats), 1000)]) if len(stats) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
