"""Language-model scoring: an interpolated modified Kneser-Ney bigram model.

Spark counts all bigrams of the training texts. Each task first aggregates what it has read, then sends
packed, sorted count blocks to shards that are chosen by a hash of the whole bigram, so a frequent word or pair
spreads out. Shards are written as sorted hash arrays into the shared folder; scoring workers map them into
memory and look up sorted batches of bigrams. Neither the counts nor the model pass through the driver, which
only sees sums (tokens, distinct words, counts of counts).

A text is its words and one end token; its first word follows a start mark that is not a token. Words and bigrams are
known by 64 bits of a hash. A word outside the training texts gets the unknown word's
share of the uniform distribution over all words and one more.

Defined cases: null and empty texts are the end token alone; repeated rows count and score each by itself;
null ids belong to the training part; without training texts every token is unknown (probability 1 of one
word); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.llm.common import LOWER, local_path, required, saved, shared_folder

WORD_BITS = 64
START, END = 0, 1  # numbers of the start mark and the end token; words get others
#: Tokens that a counting task aggregates, and a scoring task looks up, at once; shards at least.
BLOCK = 2_000_000
SCORED = 1_000_000
SHARDS = 512


def word_numbers(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens in order, and how many each text has."""
    split = [t.translate(LOWER).split() if t else [] for t in texts]
    sizes = np.array([len(w) + 1 for w in split], np.int64)
    digest = xxhash.xxh3_64_intdigest
    words = np.fromiter((digest(w) for ws in split for w in ws), np.uint64, int(sizes.sum()) - len(sizes))
    out = np.full(int(sizes.sum()), END, np.uint64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = np.maximum(words, np.uint64(2))
    return out, sizes


def previous(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.concatenate([[np.uint64(START)], tokens[:-1]]) if len(tokens) else tokens
    out[np.cumsum(sizes) - sizes] = START
    return out


def bigram_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    key = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (word * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    return key ^ (key >> np.uint64(29))


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers as byte planes, the first (sorted) as differences: high planes are zeros and compress away."""
    first = np.diff(columns[0], prepend=np.uint64(0))
    return b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in (first, *columns[1:]))


def _unpack(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(columns, 8, n)
    out = [np.ascontiguousarray(p.T).view("<u8")[:, 0] for p in planes]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _blocks(shard: np.ndarray, columns: list[np.ndarray], kind: int):
    """(shard, kind, rows, data) of the rows of each shard; rows come sorted by shard, then by the first column."""
    cuts = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1, [len(shard)]]) if len(shard) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(shard[a]), kind, int(b - a), _pack([c[a:b] for c in columns])


def _batches(rows, size: int = 64):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _block_batch(held)
            held = []
    if held:
        yield _block_batch(held)


_SCHEMA = "shard int, kind int, n int, data binary"


def _block_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["shard", "kind", "n", "data"])


def _merged(keys: np.ndarray, *columns: np.ndarray, first: tuple[np.ndarray, ...] = ()) -> tuple[np.ndarray, ...]:
    """Distinct sorted keys, sums of the columns, and the first value of others for each key."""
    order = np.argsort(keys)
    ranked = keys[order]
    starts = np.concatenate([[0], np.nonzero(ranked[1:] != ranked[:-1])[0] + 1]) if len(keys) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(c[order], starts) if len(keys) else c for c in columns]
    return ranked[starts], *sums, *(c[order[starts]] for c in first)


def _distinct(parts: list) -> list[np.ndarray]:
    """Word before, word and count of the distinct bigrams of some blocks, in the order of the bigrams' keys."""
    prev, word, n = (np.concatenate(c) for c in zip(*parts))
    _, n, prev, word = _merged(bigram_keys(prev, word), n, first=(prev, word))
    return [prev, word, n]


def _shard_of(keys: np.ndarray, bits: int, width: int) -> np.ndarray:
    return (keys >> np.uint64(width - bits)).astype(np.int64)


def _put(path: str, array: np.ndarray) -> None:
    """Write an array under a temporary name and rename it: a retry replaces the same file."""
    part = f"{path}.{TaskContext.get().taskAttemptId()}.tmp"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, path)


def counted(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """Blocks of bigram counts (word before, word, count), sorted by the word before within each shard."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            before, word = (np.concatenate(c) for c in zip(*held))
            held.clear()
            keys, n, before, word = _merged(bigram_keys(before, word), np.ones(len(before), np.uint64), first=(before, word))
            shard = _shard_of(keys, bits, 64)
            order = np.lexsort((before, shard))
            yield from _blocks(shard[order], [before[order], word[order], n[order]], 0)

        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                tokens, sizes = word_numbers(batch.column(0).slice(i, 500).to_pylist())
                held.append((previous(tokens, sizes), tokens))
                size += len(tokens)
                if size >= BLOCK:
                    yield from _batches(flush())
                    size = 0
        if held:
            yield from _batches(flush())

    return docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(count, _SCHEMA)


def bigram_shards(blocks: DataFrame, folder: str, bits: int) -> DataFrame:
    """Write each shard's bigrams as sorted arrays; blocks of what they add to each word.

    A shard's blocks are merged as they are opened, so a task holds its distinct bigrams and not all counts of them.

    Kind 1: (word, distinct words before it, tokens); kind 2: (word, distinct words after it seen once, twice, more often, all tokens
    after it); kind 3: counts of bigram counts 1 to 4, in one row with shard -1.
    """
    def write(batches):
        where = required(folder)
        of_counts = np.zeros(4, np.uint64)
        after: list = []
        before: list = []

        def words():
            if after:
                keys, n, total = _merged(*(np.concatenate(c) for c in zip(*after)))
                yield from _blocks(_shard_of(keys, bits, WORD_BITS), [keys, n, total], 1)
                keys, *sums = _merged(*(np.concatenate(c) for c in zip(*before)))
                yield from _blocks(_shard_of(keys, bits, WORD_BITS), [keys, *sums], 2)
                after.clear()
                before.clear()

        for run in _each(batches):
            parts, size, fresh = [], 0, 0
            for n, data in zip(run.column("n").to_pylist(), run.column("data").to_pylist()):
                parts.append(_unpack(data, n, 3))
                fresh += n
                if fresh > max(BLOCK, size):
                    parts, fresh = [_distinct(parts)], 0
                    size = len(parts[0][0])
            prev, word, n = _distinct(parts)
            keys = bigram_keys(prev, word)
            shard = run.column("shard")[0].as_py()
            _put(f"{where}/bigrams-{shard:05d}.npy", keys)
            _put(f"{where}/counts-{shard:05d}.npy", n.astype(np.min_scalar_type(int(n.max()))))
            of_counts += np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)[1:5].astype(np.uint64)
            one = np.ones(len(n), np.uint64)
            after.append(_merged(word, one, n))
            before.append(_merged(prev, *(x.astype(np.uint64) for x in (n == 1, n == 2, n >= 3)), n))
            if sum(len(a[0]) for a in after) > BLOCK:
                yield from _batches(words())
        yield from _batches(words())
        yield _block_batch([(-1, 3, 4, of_counts.tobytes())])

    shuffled = blocks.repartition("shard").sortWithinPartitions("shard")
    return saved(shuffled.mapInArrow(write, _SCHEMA), "words")


def _each(batches):
    """Runs of one shard, single rows too."""
    held, key = [], None
    for batch in batches:
        shards = batch.column(0).to_numpy()
        cuts = [0, *(np.nonzero(np.diff(shards))[0] + 1).tolist(), len(shards)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if key is not None and shards[a] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = shards[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


WORD_FIELDS = ("tokens", "before", "once", "twice", "more", "after")


def word_shards(blocks: DataFrame, folder: str) -> DataFrame:
    """Write each shard's words as a sorted table; ``(tokens, words, bigrams, d1..d4)``: sums of each task."""
    def write(batches):
        where = required(folder)
        sums = np.zeros(7, np.int64)
        for run in _each(batches):
            keys, values = [], []
            for kind, n, data in zip(run.column("kind").to_pylist(), run.column("n").to_pylist(), run.column("data").to_pylist()):
                key, *columns = _unpack(data, n, 3 if kind == 1 else 5)
                keys.append(key)
                zero = np.zeros(n, np.uint64)
                values.append([columns[1], columns[0], zero, zero, zero, zero] if kind == 1 else [zero, zero, *columns])
            key, *merged = _merged(np.concatenate(keys), *(np.concatenate(c) for c in zip(*values)))
            kinds = [("word", np.uint64), *((f, np.min_scalar_type(int(c.max()))) for f, c in zip(WORD_FIELDS, merged))]
            out = np.empty(len(key), kinds)
            for name, column in zip(("word", *WORD_FIELDS), (key, *merged)):
                out[name] = column
            _put(f"{where}/words-{run.column('shard')[0].as_py():05d}.npy", out)
            tokens, before = merged[0].astype(np.int64), merged[1].astype(np.int64)
            sums += [tokens.sum(), (tokens > 0).sum(), before.sum(), *np.bincount(np.minimum(before, 5), minlength=6)[1:5]]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums.tolist()], names=["tokens", "words", "bigrams", "d1", "d2", "d3", "d4"])

    shuffled = blocks.where("kind < 3").repartition("shard").sortWithinPartitions("shard")
    return shuffled.mapInArrow(write, "tokens long, words long, bigrams long, d1 long, d2 long, d3 long, d4 long")


def discounts(of_counts: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from the numbers of counts 1 to 4; plain ones where a number is missing."""
    n1, n2, n3, n4 = of_counts
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the sums that probabilities need."""

    folder: str
    bits: int
    tokens: int
    words: int
    bigrams: int
    low: tuple[float, ...]
    high: tuple[float, ...]
    low_of_counts: tuple[int, ...]
    files: frozenset[str] = frozenset()


@lru_cache(maxsize=4096)
def _mapped(path: str) -> np.ndarray:
    """An array of the shared folder, mapped into memory."""
    return np.load(path, mmap_mode="r")


class Scorer:
    def __init__(self, model: Model):
        self.model, self.folder = model, required(model.folder)

    def _file(self, name: str) -> np.ndarray | None:
        """A file of the model; None if the shard is empty. One that training wrote and that is gone now is an error."""
        return _mapped(f"{self.folder}/{name}") if name in self.model.files else None

    def _words(self, keys: np.ndarray) -> np.ndarray:
        """The fields of sorted distinct words, a row each; zeros for unknown words."""
        out = np.zeros((len(WORD_FIELDS), len(keys)))
        shard = _shard_of(keys, self.model.bits, WORD_BITS)
        cuts = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1, [len(keys)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            table = self._file(f"words-{shard[a]:05d}.npy") if b > a else None
            if table is not None:
                at = np.minimum(np.searchsorted(table["word"], keys[a:b]), len(table) - 1)
                rows = table[at]
                known = rows["word"] == keys[a:b]
                for k, f in enumerate(WORD_FIELDS):
                    out[k, a:b] = np.where(known, rows[f], 0)
        return out

    def _counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct bigrams."""
        out = np.zeros(len(keys))
        shard = _shard_of(keys, self.model.bits, 64)
        cuts = np.concatenate([[0], np.nonzero(np.diff(shard))[0] + 1, [len(keys)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            found = self._file(f"bigrams-{shard[a]:05d}.npy") if b > a else None
            if found is not None:
                at = np.minimum(np.searchsorted(found, keys[a:b]), len(found) - 1)
                out[a:b] = np.where(found[at] == keys[a:b], self._file(f"counts-{shard[a]:05d}.npy")[at], 0)
        return out

    def scores(self, texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, score) of each text."""
        m = self.model
        tokens, sizes = word_numbers(texts)
        before = previous(tokens, sizes)
        words, place = np.unique(np.concatenate([tokens, before]), return_inverse=True)
        place, place_before = place[: len(tokens)], place[len(tokens) :]
        count, seen_after, once, twice, more, after = self._words(words)
        low, high = np.array(m.low), np.array(m.high)
        if m.bigrams:  # the lower order: distinct words before a word, interpolated with the uniform distribution
            d = low[np.minimum(seen_after, 3).astype(np.int64)]
            kinds = m.low_of_counts
            freed = (low[1] * kinds[0] + low[2] * kinds[1] + low[3] * kinds[2]) / m.bigrams
            p1 = (seen_after - d) / m.bigrams + freed / (m.words + 1)
        else:
            p1 = np.ones(len(words))
        keys, back = np.unique(bigram_keys(before, tokens), return_inverse=True)
        c = self._counts(keys)[back]
        total = after[place_before]
        gamma = (high[1] * once + high[2] * twice + high[3] * more)[place_before]
        safe = np.maximum(total, 1)
        p = np.where(total > 0, (c - high[np.minimum(c, 3).astype(np.int64)]) / safe + gamma / safe * p1[place], p1[place])
        n = count[place]
        base = np.log10((n + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
        starts = np.cumsum(sizes) - sizes
        return sizes, np.add.reduceat((n > 0).astype(np.int64), starts), np.add.reduceat(base, starts), np.add.reduceat(np.log10(p), starts)


def train(docs: DataFrame, text_col: str = "text", shards: int | None = None) -> Model:
    """Count the bigrams of all rows of ``docs`` and write the model into the shared folder.

    ``shards``: files of each kind; by default SHARDS, or a quarter of the input's partitions if that is more, so that
    a shard's size stays bounded as the input grows.
    """
    spark = docs.sparkSession
    shards = shards or max(SHARDS, docs.rdd.getNumPartitions() // 4)
    bits = (shards - 1).bit_length()
    folder = shared_folder(spark, "model")
    blocks = bigram_shards(counted(docs, text_col, bits), folder, bits)
    sums = word_shards(blocks, folder).groupBy().sum().first()
    tokens, words, bigrams, *low = (x or 0 for x in sums)

    def opened(batches):
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names=["n1", "n2", "n3", "n4"])

    found = blocks.where("kind = 3").select("data").mapInArrow(opened, "n1 long, n2 long, n3 long, n4 long").groupBy().sum().first()
    high = [x or 0 for x in found]
    rest = int(bigrams and words - low[0] - low[1])
    files = frozenset(f for f in os.listdir(local_path(folder)) if f.endswith(".npy"))
    return Model(folder, bits, tokens, words, bigrams, tuple(map(float, discounts(low))), tuple(map(float, discounts(high))), (low[0], low[1], rest), files)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score)`` of every row; scores are log10 probabilities."""

    def scan(batches):
        scorer = Scorer(model)
        for batch in batches:
            i = 0
            sizes = np.cumsum(np.array(pc.binary_length(batch.column(1)).fill_null(0)) // 5 + 1)
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + SCORED)))
                n, known, base, score = scorer.scores(batch.column(1).slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n), pa.array(known), pa.array(base), pa.array(score)], names=["id", "n_tokens", "n_known", "base_score", "score"])
                i = j

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(scan, "id long, n_tokens long, n_known long, base_score double, score double")
