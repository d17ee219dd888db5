"""Benchmark decontamination: a broadcast hash set of normalised test n-grams scanned over training words.

Words are runs of ASCII letters and digits (lower-cased) and bytes above 0x7F. A window is ``window``
consecutive words of a benchmark item; an item with fewer words, but not none, is one window of its own
length. A document word inside any occurrence of a window is hit.

Defined cases: null and empty texts have no words and are never hit; items without words match nothing;
several items with one id count as that id once; items with a null id mark words as hit but name no item; repeated
document rows each get the same result; empty tables give empty or untouched results; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that separate words become spaces, capital ASCII letters become small ones.
NORMAL = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
#: Benchmark text of one pass, in bytes; a larger benchmark is scanned in several passes. A window takes 20 bytes of the index
#: beside its text, so a broadcast is 5 times the text for words of a usual length, and 11 times at most.
BROADCAST_BYTES = 16 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class WindowIndex:
    """The windows of some benchmark items as arrays: hashes sorted within each length, and where each window's words stand.

    ``items``: (item id or None, text). All texts' normalised words are kept in one byte string, to verify matches exactly.
    """

    def __init__(self, items: list[tuple[object, bytes]], window: int = 13):
        self.items: list = []
        texts, hashed, first, last, item, length = [], [], [], [], [], []
        place = 0
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            n = min(window, len(words))
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) + place
            starts = np.concatenate([[place], ends[:-1]])
            count = len(words) - n + 1
            first.append(starts[:count])
            last.append(ends[n - 1 :] - 1)
            item.append(np.full(count, len(self.items), np.int32))
            length.append(np.full(count, n, np.int32))
            texts.append(b" ".join(words))
            hashed.append((_hashes(words), n))
            self.items.append(name)
            place = int(ends[-1])
        self.text = b" ".join(texts)
        self.words = np.unique(np.concatenate([h for h, _ in hashed])) if hashed else np.zeros(0, np.uint64)
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        if hashed:
            rolled = np.concatenate([self._rolled(h, n) for h, n in hashed])
            small = np.uint32 if place < 1 << 32 else np.uint64
            columns = [np.concatenate(first).astype(small), np.concatenate(last).astype(small), np.concatenate(item)]
            length = np.concatenate(length)
            for n in np.unique(length).tolist():
                at = np.nonzero(length == n)[0]
                at = at[np.lexsort((columns[2][at], rolled[at]))]
                self.by_length[n] = (rolled[at], *(c[at] for c in columns))

    @staticmethod
    def _rolled(words: np.ndarray, n: int) -> np.ndarray:
        """A hash of every window of ``n`` words."""
        count = len(words) - n + 1
        out = np.zeros(count, np.uint64)
        for i in range(n):
            out = (out ^ words[i : i + count]) * _MULTIPLIER
            out ^= out >> np.uint64(29)
        return out

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int, list]]:
        """(start, length, item ids) of every window that occurs; every hash match is verified word by word."""
        if not len(self.words) or not words:
            return
        hashed = _hashes(words)
        known = self.words[np.minimum(np.searchsorted(self.words, hashed), len(self.words) - 1)] == hashed
        unknown = np.concatenate([[0], np.cumsum(~known)])
        for n, (hashes, first, last, item) in self.by_length.items():
            if len(words) < n:
                continue
            starts = np.nonzero(unknown[n:] == unknown[: len(words) - n + 1])[0]
            if not len(starts):
                continue
            rolled = np.zeros(len(starts), np.uint64)
            for i in range(n):
                rolled = (rolled ^ hashed[starts + i]) * _MULTIPLIER
                rolled ^= rolled >> np.uint64(29)
            low, high = np.searchsorted(hashes, rolled), np.searchsorted(hashes, rolled, side="right")
            found: dict[bytes, list | None] = {}  # windows that the document repeats are looked up once
            for k in np.nonzero(high > low)[0].tolist():
                text = b" ".join(words[starts[k] : starts[k] + n])
                if text not in found:
                    same = [j for j in range(low[k], high[k]) if self.text[first[j] : last[j]] == text]
                    found[text] = [self.items[j] for j in np.unique(item[same]).tolist()] if same else None
                if found[text] is not None:
                    yield int(starts[k]), n, found[text]


def _shards(items: DataFrame, item_col: str, text_col: str, limit: int) -> list[DataFrame]:
    """The benchmark, in parts of a checked size: the driver never holds more than one part."""
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("binary").alias("t")).where("t is not null")
    total = rows.agg(F.sum(F.length("t") + 64)).first()[0] or 0
    parts = -(-total // limit) or 1
    if parts == 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64("item", "t"), F.lit(2 * parts)) == i) for i in range(2 * parts)]


def _index_holder(spark, items: DataFrame, window: int):
    """A broadcast of the index of one part."""
    shipped = spark.sparkContext.broadcast(WindowIndex([(r.item, bytes(r.t)) for r in items.toLocalIterator()], window))
    return lambda: shipped.value


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    return list(zip(np.nonzero(edges == 1)[0].tolist(), np.nonzero(edges == -1)[0].tolist()))


_SPAN = T.StructType().add("a", T.LongType()).add("b", T.LongType())
_SPANS = T.StructType().add("n", T.LongType()).add("spans", T.ArrayType(_SPAN)).add("items", T.ArrayType(T.StringType()))
_SPANS_ARROW = pa.struct([
    ("n", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("items", pa.list_(pa.string())),
])


def _free_name(columns: list[str]) -> str:
    name = "hits"
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


def marked(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
           window: int = 13, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, str]:
    """``docs`` and one more column (its name is the second result): words, hit spans [from, to) in words, item ids as sorted strings.

    The documents aren't shuffled. If the benchmark is larger than ``broadcast_bytes`` the scan is repeated for each
    part of it, adding to the spans and items found so far, so that no broadcast passes the limit.
    """
    name = _free_name(docs.columns)
    place, last = docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, _SPANS)])
    out = docs.withColumn(name, F.lit(None).cast(_SPANS))
    for part in _shards(items, item_id_col, item_text_col, broadcast_bytes):
        index = _index_holder(docs.sparkSession, part, window)

        def scan(batches, index=index):
            for batch in batches:
                found = []
                for text, old in zip(batch.column(place).to_pylist(), batch.column(last).to_pylist()):
                    words = words_of(text.encode() if text else None)
                    seen, hit = set(old["items"] if old else ()), np.zeros(len(words), bool)
                    for span in old["spans"] if old else ():
                        hit[span["a"] : span["b"]] = True
                    for start, n, ids in index().occurrences(words):
                        hit[start : start + n] = True
                        seen.update(str(x) for x in ids if x is not None)
                    found.append({"n": len(words), "spans": [{"a": a, "b": b} for a, b in _spans(hit)] if hit.any() else [], "items": sorted(seen)})
                yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found, _SPANS_ARROW)], names=[*batch.schema.names[:last], name])

        out = out.mapInArrow(scan, schema)
    return out, name


def _n_hit(name: str) -> F.Column:
    return F.aggregate(F.col(name)["spans"], F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])


def digest(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    found, name = marked(rows, items, "t", **options)
    names = F.col(name)["items"]
    return found.select(
        "id", F.col(name)["n"].alias("n_words"), _n_hit(name).alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
    )


def dropped(docs: DataFrame, items: DataFrame, text_col: str = "text", one_in: int = 20, **options) -> DataFrame:
    """``docs`` without the documents of which at least one word in ``one_in`` (and at least one) is hit; all columns stay."""
    found, name = marked(docs, items, text_col, **options)
    n_hit = _n_hit(name)
    return found.where(~((n_hit > 0) & (n_hit * one_in >= F.col(name)["n"]))).drop(name)


def cut(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the characters from the first to the last word of every hit span cut out of the text; all columns stay."""
    found, name = marked(docs, items, text_col, **options)
    place, last, schema = docs.columns.index(text_col), len(docs.columns), docs.schema

    def without(batches):
        for batch in batches:
            texts = [_without(t, [(s["a"], s["b"]) for s in h["spans"]]) for t, h in zip(batch.column(place).to_pylist(), batch.column(last).to_pylist())]
            columns = list(batch.columns[:last])
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:last])

    return found.mapInArrow(without, schema)


def _without(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    if not spans:
        return text
    raw = text.encode()
    flat, places, at = raw.translate(NORMAL), [], 0
    for word in flat.split():
        at = flat.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last : places[a][0]])
        last = places[b - 1][1]
    return b"".join([*out, raw[last:]]).decode()
