"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

A shard is some 8 MB of text, indexed by the task that reads it, so documents aren't shuffled. A term's list in a
shard is cut into blocks of 128 documents, compressed, each with its greatest impact (a document's score for the
term before the term's weight). Searching ships only the blocks of the queries' terms, by shard. In a shard:

- every list has a global bound, its weight times the term's greatest impact in any shard; the lists with the least
  bounds whose sum can't pass the threshold (the score of the k-th best document so far) are non-essential: only documents of
  the other, essential lists are candidates;
- non-essential lists are visited from the greatest bound down; a candidate is rejected by the block's maximum and the bounds
  of the lists to come before the block is decompressed;
- documents are visited in windows of rising numbers, each as arrays, so that the threshold rises between windows.

A task carries its heaps from shard to shard and returns them merged; the heaps of tasks meet in a window per query.

Defined cases: null and empty texts have no terms and aren't documents of the statistics; queries without terms, or with terms of no
document, give no rows; queries that repeat, or share an id, are ranked each by itself; ties go by ascending document id, null ids last;
repeated rows are documents of their own; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratovox.llm.common import runs, saved
from stratovox.llm.decontaminate import NORMAL, words_of
from stratovox.llm.words import Words, slices, split_words

BLOCK = 128
SHARD_BYTES = 8 << 20
#: Text of the queries of one pass, in bytes: their terms are broadcast; more queries are searched in several passes.
QUERY_BYTES = 4 << 20
#: Documents of a shard's first window; each next one is twice as long.
FIRST_WINDOW = 512
_INDEX = "shard long, term long, at int, n int, first int, last int, most long, data binary"
_ARROW = pa.schema([("shard", pa.int64()), ("term", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("most", pa.int64()), ("data", pa.binary())])


@dataclass(frozen=True)
class Index:
    """Blocks of all terms (and a row with ``at`` -1 for each shard's documents), and the corpus statistics they were built with."""

    blocks: DataFrame
    documents: int
    words: int


def term_number(word: bytes) -> int:
    """A term's 64-bit hash, signed."""
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers as bytes of seven bits, the lowest first, all but the last of a number marked; and each number's place."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << 7 * k)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max()) if len(v) else 0):
        more = size > k
        byte = (v[more] >> np.uint64(7 * k)) & np.uint64(127)
        out[place[more] + k] = byte.astype(np.uint8) | np.where(size[more] > k + 1, 128, 0).astype(np.uint8)
    return out, place


def unpacked(data: np.ndarray) -> np.ndarray:
    last = data < 128
    first = np.concatenate([[True], last[:-1]])
    starts = np.flatnonzero(first)
    within = np.arange(len(data)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(data)]])))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * within), starts) if len(data) else np.zeros(0, np.int64)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _statistics(docs: DataFrame) -> tuple[int, int]:
    def count(batches):
        n = total = 0
        for part in slices(batches, 0, SHARD_BYTES):
            each = split_words(part.column(0), NORMAL).per_text()
            n, total = n + int((each > 0).sum()), total + int(each.sum())
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total]})

    found = docs.select("t").mapInArrow(count, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


def _shard_rows(shard: int, ids: pa.Array, words: Words, documents: int, total: int):
    """Index rows of one shard; its documents stand in the order of their ids."""
    each = words.per_text()
    m = 75 + 25 * each * documents // max(total, 1)
    numbers = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    data = [numbers.astype("<i8").tobytes() + m.astype("<i8").tobytes() + ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, 0, -1, len(ids), 0, 0, 0, data[0]), _ARROW)], schema=_ARROW)
    if not len(words.start):
        return
    code, distinct = words.encoded()
    hashes = np.array([term_number(w) for w in distinct], np.int64)
    order = np.argsort(hashes, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    key, tf = np.unique(rank[code] * words.texts + words.text, return_counts=True)
    term, doc = key // words.texts, key % words.texts
    s = impacts(tf.astype(np.int64), m[doc])
    begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    place = np.arange(len(term)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(term)]])))
    cut = np.flatnonzero(place % BLOCK == 0)
    gap = np.diff(doc, prepend=0)
    gap[cut] = 0
    pairs = np.empty(2 * len(doc), np.int64)
    pairs[0::2], pairs[1::2] = gap, tf
    stream, at = packed(pairs)
    n = np.diff(np.concatenate([cut, [len(doc)]]))
    columns = [np.full(len(cut), shard, np.int64), hashes[order][term[cut]], (place[cut] // BLOCK).astype(np.int32), n.astype(np.int32), doc[cut].astype(np.int32),
               doc[cut + n - 1].astype(np.int32), np.maximum.reduceat(s, cut)]
    bytes_at = np.concatenate([at[2 * cut], [len(stream)]]).astype(np.int32)
    blobs = pa.BinaryArray.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(bytes_at), pa.py_buffer(stream.tobytes())])
    found = pa.RecordBatch.from_arrays([*map(pa.array, columns), blobs], schema=_ARROW)
    for i in range(0, len(cut), 1 << 16):
        yield found.slice(i, 1 << 16)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Index:
    """Index all rows of ``docs`` (ids are longs); two scans, no shuffle. The index is written to the shared folder."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    documents, total = _statistics(rows)

    def index(batches):
        held, size, shard = [], 0, TaskContext.get().partitionId() << 24

        def flush():
            table = pa.Table.from_batches(held).sort_by("id").combine_chunks()  # null ids last
            yield from _shard_rows(shard, table.column("id").combine_chunks(), split_words(table.column("t").combine_chunks(), NORMAL), documents, total)

        for part in slices(batches, 1, shard_bytes):
            if held and size + part.nbytes > shard_bytes:
                yield from flush()
                held, size, shard = [], 0, shard + 1
            held.append(part)
            size += part.nbytes
        if held:
            yield from flush()

    return Index(saved(rows.mapInArrow(index, _INDEX), "lexical-index"), documents, total)


class Shard:
    """The lists of one shard that some queries need; blocks are decompressed when they are first wanted, and kept."""

    def __init__(self, table: pa.Table):
        column = lambda name: table.column(name).to_numpy()
        term, at = column("term"), column("at")
        docs = int(np.flatnonzero(at == -1)[0])
        self.size = int(column("n")[docs])
        raw = table.column("data")[docs].as_py()
        self.ids = np.frombuffer(raw, "<i8", self.size)
        self.m = np.frombuffer(raw, "<i8", self.size, 8 * self.size)
        self.null = np.frombuffer(raw, np.uint8, self.size, 16 * self.size).astype(bool)
        rows = np.flatnonzero(at >= 0)
        rows = rows[np.lexsort((at[rows], term[rows]))]
        self.first, self.last, self.most, self.n = (column(c)[rows].astype(np.int64) for c in ("first", "last", "most", "n"))
        self.data = table.column("data").take(pa.array(rows)).to_pylist()
        own, begin, count = np.unique(term[rows], return_index=True, return_counts=True)
        self.lists = {t: (a, a + n) for t, a, n in zip(own.tolist(), begin.tolist(), count.tolist())}
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def blocks(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks of one list, in order."""
        new = [b for b in which.tolist() if b not in self.open]
        if new:
            pairs = unpacked(np.frombuffer(b"".join(self.data[b] for b in new), np.uint8))
            count = self.n[new]
            begin = np.cumsum(count) - count
            run = np.cumsum(pairs[0::2])
            doc = run + np.repeat(self.first[new] - run[begin], count)
            s = impacts(pairs[1::2], self.m[doc])
            for b, a, n in zip(new, begin.tolist(), count.tolist()):
                self.open[b] = doc[a : a + n], s[a : a + n]
        found = [self.open[b] for b in which.tolist()]
        if len(found) == 1:
            return found[0]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def best(shard: Shard, terms: list[tuple[int, int, int]], k: int, least: int = 0, first_window: int = FIRST_WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the shard's ``k`` best documents of those that score above ``least``, best first (ties: lesser numbers).

    ``terms``: number, weight in the query, and greatest impact anywhere, of each term.
    """
    lists = sorted(((w * most, w, *shard.lists[t]) for t, w, most in terms if t in shard.lists and w > 0))
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    below = np.concatenate([[0], np.cumsum([b for b, *_ in lists])])  # bounds of all lists before each
    docs, scores, low, width = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, first_window
    while low < shard.size:
        high = min(low + width, shard.size)
        split = int(np.searchsorted(below[1:], least, side="right"))  # lists before this place are non-essential
        if split == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for _, w, a, b in lists[split:]:
            i, j = a + np.searchsorted(shard.last[a:b], low), a + np.searchsorted(shard.first[a:b], high)
            if i < j:
                doc, s = shard.blocks(np.arange(i, j))
                x, y = np.searchsorted(doc, (low, high))
                total[doc[x:y] - low] += w * s[x:y]
        found = np.flatnonzero(total)
        held = total[found]
        found += low
        for i in range(split - 1, -1, -1):
            _, w, a, b = lists[i]
            open_ = held + below[i + 1] > least
            found, held = found[open_], held[open_]
            if not len(found):
                break
            block = a + np.searchsorted(shard.last[a:b], found)
            inside = (block < b) & (shard.first[np.minimum(block, b - 1)] <= found)
            bound = np.where(inside, w * shard.most[np.minimum(block, b - 1)], 0)
            open_ = held + bound + below[i] > least  # rejected by the block's maximum, not decompressed
            found, held, block, inside = found[open_], held[open_], block[open_], inside[open_]
            if inside.any():
                doc, s = shard.blocks(np.unique(block[inside]))
                at = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                held = held + np.where(doc[at] == found, w * s[at], 0)
        win = held > least
        docs, scores = np.concatenate([docs, found[win]]), np.concatenate([scores, held[win]])
        if len(docs) >= k:
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            least = int(scores[-1])
        low, width = high, 2 * width
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def _passes(items: DataFrame, limit: int) -> list[DataFrame]:
    """The queries in parts of a checked size."""
    total = items.agg(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)) + 64)).first()[0] or 0
    parts = -(-total // limit)
    if parts <= 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item", "t"), F.lit(2 * parts)) == i) for i in range(2 * parts)]


def search(index: Index, items: DataFrame, k: int = 20, item_id_col: str = "item_id", item_text_col: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``item, rank, id, score``: each query's ``k`` best documents with a score above 0, best first."""
    spark = index.blocks.sparkSession
    rows = items.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("t"))
    kind = rows.schema["item"].dataType
    out = [spark.createDataFrame([], T.StructType([T.StructField("item", kind)]).add("rank", "integer").add("id", "long").add("score", "long"))]
    for part in _passes(rows, query_bytes):
        asked = [(r.item, {term_number(w): n for w, n in Counter(words_of(r.t.encode() if r.t else None)).items()}) for r in part.toLocalIterator()]
        terms = sorted({t for _, found in asked for t in found})
        if not terms or not index.documents:
            continue
        wanted = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term long"))
        lists = index.blocks.where("at >= 0").join(wanted, "term", "left_semi")
        known = {r.term: (r.df, r.most) for r in lists.groupBy("term").agg(F.sum("n").alias("df"), F.max("most").alias("most")).toLocalIterator()}
        weight = {t: math.floor(1000 * math.log((2 * index.documents + 2) / (2 * df + 1))) for t, (df, _) in known.items()}
        plan = [[(t, weight[t] * n, known[t][1]) for t, n in found.items() if t in known] for _, found in asked]
        shipped = spark.sparkContext.broadcast(plan)
        columns = ["shard", "term", "at", "n", "first", "last", "most", "data"]
        dealt = lists.select(*columns).unionByName(index.blocks.where("at = -1").select(*columns)).repartition("shard").sortWithinPartitions("shard")
        heaps = dealt.mapInArrow(_searching(shipped, k), "q long, id long, score long")
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = T.StructType().add("q", "long").add(T.StructField("item", kind))
        named = F.broadcast(spark.createDataFrame([(q, item) for q, (item, _) in enumerate(asked)], names))
        out.append(ranked.join(named, "q").select("item", "rank", "id", "score"))
    found = out[-1]
    for more in out[1:-1]:
        found = found.unionByName(more)
    return found


def _searching(shipped, k: int):
    def run(batches):
        heaps: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for table in runs(batches, 1):
            shard = Shard(table)
            for q, terms in enumerate(shipped.value):
                held = heaps.get(q)
                least = max(0, int(held[0][-1]) - 1) if held and len(held[0]) == k else 0  # an equal score may have a lesser id here
                docs, scores = best(shard, terms, k, least)
                if len(docs):
                    found = scores, shard.ids[docs], shard.null[docs]
                    if held:
                        found = tuple(np.concatenate(x) for x in zip(held, found))
                    order = np.lexsort((found[1], found[2], -found[0]))[:k]
                    heaps[q] = tuple(x[order] for x in found)
        for q, (scores, ids, null) in heaps.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), q)), pa.array(ids, mask=null), pa.array(scores)], names=["q", "id", "score"])

    return run
