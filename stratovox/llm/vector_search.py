"""Exact top-k search by integer inner product over a bit-sliced index.

A vector's components become whole numbers, floor(scale * x). Vectors are dealt to blocks of some thousand rows, in the order of their
ids; a block keeps, for each component, the distance from the block's least value in binary, a bitmap of all rows for each binary digit
(slice). A query's scores of a whole block come from bitmap arithmetic: a slice is added once for each set digit of the
query's component (its complement, if the component is negative), three bitmaps of one place giving one of it and one of the next,
until each place has a single bitmap, the scores' slices. The best rows are then taken from the most significant slice downward;
the rows that still tie at the boundary are resolved by their ids, exactly.

Queries are held in parts of a checked size, each a pass over the index; every block is one row, so a task holds a block and a part. Rows
of a pass meet in a window per query, after each task has merged its blocks.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; a query meets vectors of its own length, and none
with its own id; repeated query rows are answered each; ties go to the lesser id; null ids are no queries and stand last
among ties; empty tables give empty results; other columns are ignored. Components have to be below 2^20 after scaling, so that sums stay
exact; larger ones are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratovox.llm.common import saved

#: Rows of a block at most; rows that are worth a task of their own.
BLOCK = 1 << 14
LEAST_ROWS = 1 << 10
#: Bytes of the queries of one pass, as 32-bit components.
QUERY_BYTES = 32 << 20
LIMIT = 1 << 20
_NO_ID = np.iinfo(np.int64).max


def _usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v``: the rows that take part, quantised."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where(F.col("x").isNotNull() & whole)
    small = lambda c: F.when(F.abs(c) < LIMIT, c.cast("int")).otherwise(F.raise_error(F.lit("a component is too large for exact sums")).cast("int"))
    return rows.select("id", F.transform("x", lambda c: small(F.floor(c * scale).cast("double"))).alias("v"))


def _matrices(batch: pa.RecordBatch):
    """Ids, which of them are null, and the matrix of vectors, for each length that occurs."""
    lists = batch.column(1)
    start = lists.offsets.to_numpy()[:-1]
    size = np.diff(lists.offsets.to_numpy())
    values = lists.values.to_numpy(zero_copy_only=False)
    ids, null = batch.column(0).fill_null(_NO_ID).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        yield ids[at], null[at], values[start[at][:, None] + np.arange(n)].astype(np.int64)


class Slices:
    """A block: bitmaps of the binary digits of each component's distance from its least value, and their complements."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, low: np.ndarray, digits: np.ndarray, maps: np.ndarray):
        self.ids, self.null, self.low, self.digits = ids, null, low, digits
        self.maps = np.concatenate([maps, ~maps])  # (2 * slices, words)
        self.begin = np.cumsum(digits) - digits

    @classmethod
    def of(cls, ids: np.ndarray, null: np.ndarray, v: np.ndarray) -> Slices:
        order = np.lexsort((ids, null))
        ids, null, v = ids[order], null[order], v[order]
        low = v.min(axis=0)
        digits = np.array([int(x).bit_length() for x in (v.max(axis=0) - low)], np.int64)
        words = -(-len(ids) // 64)
        maps = np.zeros((int(digits.sum()), words), np.uint64)
        k = 0
        for c, n in enumerate(digits.tolist()):
            u = np.zeros(words * 64, np.int64)
            u[: len(ids)] = v[:, c] - low[c]
            for digit in range(n):
                maps[k] = np.packbits((u >> digit & 1).astype(np.uint8), bitorder="little").view("<u8")
                k += 1
        return cls(ids, null, low, digits, maps)

    def places(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The bitmaps to add at each place, and what has to be added to their sum to get the score."""
        size, constant = np.abs(query), int(query @ self.low)
        negative = query < 0
        # -q u = q (2^digits - 1 - u) - q (2^digits - 1)
        constant -= int((size[negative] * ((1 << self.digits[negative]) - 1)).sum())
        which, place = [], []
        for digit in range(int(size.max()).bit_length() if len(size) else 0):
            c = np.flatnonzero(size >> digit & 1)
            n = self.digits[c]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            which.append(np.repeat(self.begin[c] + negative[c] * (len(self.maps) // 2), n) + step)
            place.append(step + digit)
        which, place = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (which, place))
        if not len(which):  # nothing to add: the block's rows are all equal, or the query is zero
            return [], constant
        order = np.argsort(place, kind="stable")
        return np.split(which[order], np.searchsorted(place[order], np.arange(1, int(place.max()) + 1))), constant

    def scores(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """Slices of all rows' sums, the least significant first, and the constant that makes them scores."""
        places, constant = self.places(query)
        carried, out, p = [], [], 0
        while p < len(places) or carried:
            rows = self.maps[places[p]] if p < len(places) else np.zeros((0, self.maps.shape[1]), np.uint64)
            rows, carried = np.concatenate([rows, *carried]), []
            while len(rows) > 2:
                n = len(rows) // 3
                a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
                half = a ^ b
                carried.append((a & b) | (half & c))
                rows = np.concatenate([half ^ c, rows[3 * n :]])
            if len(rows) == 2:
                carried.append((rows[0] & rows[1])[None])
                rows = (rows[0] ^ rows[1])[None]
            out.append(rows[0] if len(rows) else np.zeros(self.maps.shape[1], np.uint64))
            p += 1
        return (np.stack(out) if out else np.zeros((0, self.maps.shape[1]), np.uint64)), constant

    def best(self, query: np.ndarray, own: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best rows whose id isn't ``own``, best first."""
        sums, constant = self.scores(query)
        open_ = np.packbits(np.arange(self.maps.shape[1] * 64) < len(self.ids), bitorder="little").view("<u8")
        if own is not None:
            a, b = np.searchsorted(self.ids[~self.null], (own, own + 1)) if own != _NO_ID else (0, 0)
            for row in range(a, b):
                open_[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        sure, held = np.zeros_like(open_), 0  # rows that are taken, and how many
        for bits in sums[::-1]:
            up = open_ & bits
            n = int(np.bitwise_count(up).sum())
            if held + n > k:
                open_ = up
            else:
                sure, held, open_ = sure | up, held + n, open_ & ~bits
        # the rows that are open tie at the boundary: the first of them, by id
        rows = np.concatenate([self._rows(sure), self._rows(open_)[: k - held]])
        words, bit = rows >> 6, (rows & 63).astype(np.uint64)
        score = np.full(len(rows), constant, np.int64)
        for digit, bits in enumerate(sums):
            score += ((bits[words] >> bit) & np.uint64(1)).astype(np.int64) << digit
        order = np.lexsort((rows, -score))
        return rows[order], score[order]

    @staticmethod
    def _rows(bits: np.ndarray) -> np.ndarray:
        words = np.flatnonzero(bits)
        inside = np.unpackbits(np.ascontiguousarray(bits[words]).view(np.uint8), bitorder="little").reshape(-1, 64)
        at, bit = np.nonzero(inside)
        return words[at] * 64 + bit


_INDEX = "length int, n int, ids binary, missing binary, low binary, digits binary, maps binary"


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, block: int = BLOCK) -> DataFrame:
    """The index: a row for each block, written to the shared folder. The vectors are dealt out evenly once, whatever their ids."""
    rows = _usable(vectors, id_col, vector_col, scale)
    n, tasks = vectors.count(), vectors.sparkSession.sparkContext.defaultParallelism

    def sliced(batches):
        held, size = {}, {}

        def out(parts):
            s = Slices.of(*(np.concatenate(x) for x in zip(*parts)))
            fields = (len(s.low), len(s.ids), *(x.tobytes() for x in (s.ids.astype("<i8"), s.null.astype(np.uint8), s.low.astype("<i8"), s.digits.astype("<i8"), s.maps[: len(s.maps) // 2])))
            kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
            return pa.RecordBatch.from_arrays([pa.array([f], k) for f, k in zip(fields, kinds)], names=["length", "n", "ids", "missing", "low", "digits", "maps"])

        for batch in batches:
            for ids, null, v in _matrices(batch):
                for i in range(0, len(ids), block):
                    part, key = (ids[i : i + block], null[i : i + block], v[i : i + block]), v.shape[1]
                    if size.get(key, 0) + len(part[0]) > block:
                        yield out(held.pop(key))
                        size[key] = 0
                    held.setdefault(key, []).append(part)
                    size[key] = size.get(key, 0) + len(part[0])
        for parts in held.values():
            yield out(parts)

    dealt = rows.repartition(max(1, -(-n // block), min(tasks, -(-n // LEAST_ROWS))))
    return saved(dealt.mapInArrow(sliced, _INDEX), "bit-slices")


def search(index: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query, rank, id, score``: the ``k`` highest scores of each query among the indexed vectors with other ids."""
    rows = saved(_usable(queries.where(F.col(id_col).isNotNull()), id_col, vector_col, scale), "queries")
    total = rows.agg(F.sum(4 * F.size("v") + 64)).first()[0] or 0
    parts = -(-total // query_bytes)
    parts = [rows] if parts <= 1 else [rows.where(F.pmod(F.xxhash64("id", "v"), F.lit(2 * parts)) == i) for i in range(2 * parts)]
    order, out = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id")), None
    for part in parts:
        asked = [(r.id, np.array(r.v, np.int64)) for r in part.toLocalIterator()]
        shipped = index.sparkSession.sparkContext.broadcast(asked)
        heaps = index.mapInArrow(_searching(shipped, k), "q long, query long, id long, score long")
        ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _searching(shipped, k: int):
    def run(batches):
        heaps: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for length, n, ids, missing, low, digits, maps in zip(*(c.to_pylist() for c in batch.columns)):
                digits = np.frombuffer(digits, "<i8")
                block = Slices(np.frombuffer(ids, "<i8"), np.frombuffer(missing, np.uint8).astype(bool), np.frombuffer(low, "<i8"), digits, np.frombuffer(maps, "<u8").reshape(int(digits.sum()), -(-n // 64)))
                for q, (own, query) in enumerate(shipped.value):
                    if len(query) != length:
                        continue
                    at, score = block.best(query, own, k)
                    found = score, block.ids[at], block.null[at]
                    if q in heaps:
                        found = tuple(np.concatenate(x) for x in zip(heaps[q], found))
                    best = np.lexsort((found[1], found[2], -found[0]))[:k]
                    heaps[q] = tuple(x[best] for x in found)
        for q, (score, ids, null) in heaps.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q)), pa.array(np.full(len(ids), shipped.value[q][0])), pa.array(ids, mask=null), pa.array(score)], names=["q", "query", "id", "score"])

    return run
