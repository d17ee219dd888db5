"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A bin is filled greedily with the longest unpacked pieces that fit. Then its smallest piece is taken out
and two unpacked pieces that fill the widened gap more tightly are put in its place, if there are such.

Pieces are dealt evenly over groups of a fixed size and each group is packed by itself, so a task holds a
bounded number of (length, id) pairs and never a text; a group leaves at most one bin poorly filled.

Defined cases: a null or empty text is the single end token; repeated rows are packed as often as they
occur; a text longer than a sequence is cut into full pieces and a last one; an empty table gives an empty
result; other columns are ignored. Null ids are packed like any other.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratovox.llm.common import LOWER, saved

#: Pieces that one task packs.
GROUP = 50_000
#: Distinct words whose token ids a Python worker remembers.
REMEMBERED = 500_000


_TAIL = re.compile(rb"(?<=[a-z])([.,]+)(?=[\t-\r ]|\Z)")


class Tokens:
    """Token ids of texts as little-endian 32-bit bytes; words are encoded once and remembered.

    The tokenizer lower-cases, drops white space and never joins what it separates, so a text's ids are those of
    its words. Full stops and commas that end a word after an ASCII letter are tokens of their own, and are split
    off, so that fewer distinct words have to be encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _words(self, text: bytes) -> list[bytes]:
        # special tokens are told by their capital letters too
        return text.split() if b"<|" in text else _TAIL.sub(rb" \1", text.translate(LOWER)).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        get = self.known.get
        parts = [list(map(get, words)) for words in split]
        new = list({w for words, found in zip(split, parts) if None in found for w, p in zip(words, found) if p is None})
        extra: dict[bytes, bytes] = {}
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            for word, found in zip(part, self.encoder.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                extra[word] = struct.pack(f"<{len(found.ids)}I", *found.ids)
        if len(self.known) < REMEMBERED:
            self.known.update(extra)
        return [b"".join([extra[w] if p is None else p for w, p in zip(words, found)] if None in found else found) for words, found in zip(split, parts)]


@lru_cache(maxsize=4)
def worker_tokens(path: str) -> Tokens:
    """One for each Python worker, kept from task to task."""
    return Tokens(path)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, end_id: int = 1) -> DataFrame:
    """``(id, piece, start, length, crc)`` for every piece; ``crc`` is that of its ids as little-endian 32-bit numbers."""

    def scan(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = worker_tokens(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.columns
            for at in range(0, len(ids), 500):
                part = ids.slice(at, 500)
                out: list[list] = [[], [], [], [], []]
                encoded = tokens.encode([t or b"" for t in texts.slice(at, 500).to_pylist()])
                for doc, data in zip(part.to_pylist(), encoded):
                    data += end
                    for k, i in enumerate(range(0, len(data), 4 * limit)):
                        piece = data[i : i + 4 * limit]
                        for column, value in zip(out, (doc, k, i // 4, len(piece) // 4, zlib.crc32(piece))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["id", "piece", "start", "length", "crc"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(scan, "id long, piece int, start long, length long, crc long")


def best_two_fit(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece. Pieces of one length are exchangeable; the later in the input is used first."""
    stock: dict[int, list[int]] = defaultdict(list)
    for i, n in enumerate(lengths.tolist()):
        stock[n].append(i)
    left = np.zeros(limit + 1, np.int64)  # unpacked pieces of each length
    for n, found in stock.items():
        left[n] = len(found)
    sizes = np.arange(limit + 1)
    fits = np.maximum.accumulate(np.where(left > 0, sizes, 0))  # the longest unpacked length up to each length

    def take(n: int) -> int:
        left[n] -= 1
        if not left[n]:
            below = int(fits[n - 1])
            stop = n + int(np.argmax(left[n:] > 0)) if (left[n:] > 0).any() else limit + 1
            fits[n:stop] = below
        return stock[n].pop()

    def give_back(i: int, n: int) -> None:
        if not left[n]:
            stop = n + 1 + int(np.argmax(left[n + 1 :] > 0)) if (left[n + 1 :] > 0).any() else limit + 1
            fits[n:stop] = n
        left[n] += 1
        stock[n].append(i)

    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    while fits[limit]:
        held, gap = [], limit
        while gap and fits[gap]:
            n = int(fits[gap])
            held.append((n, take(n)))
            gap -= n
        if gap and held:
            smallest = held[-1][0]  # taken in falling order of length
            wide = gap + smallest
            firsts = np.nonzero(left[: wide + 1])[0]
            seconds = fits[wide - firsts]
            alone = (seconds == firsts) & (left[firsts] < 2)
            seconds = np.where(alone, fits[np.maximum(firsts - 1, 0)], seconds)
            total = np.where(seconds > 0, firsts + seconds, 0)
            if len(total) and total.max() > smallest:
                best = int(np.argmax(total))
                n, i = held.pop()
                pair = [(int(x), take(int(x))) for x in (firsts[best], seconds[best])]
                give_back(i, n)
                held += pair
        offset = 0
        for n, i in held:
            bins[i], offsets[i] = number, offset
            offset += n
        number += 1
    return bins, offsets


def packed(found: DataFrame, limit: int = 4096, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of :func:`pieces`. The table is written once, so that a lost
    executor's retry packs the same pieces again."""
    found = saved(found, "pieces")
    groups = -(-found.count() // group) or 1
    placed = found.repartition(groups).withColumn("sequence_id", F.spark_partition_id().cast("long"))

    def pack(batches):
        rows = list(batches)
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        bins, offsets = best_two_fit(table.column("length").to_numpy(), limit)
        base = table.column("sequence_id")[0].as_py() << 32 if len(table) else 0
        table = table.set_column(5, "sequence_id", pa.array(bins + base, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))
        yield from table.combine_chunks().to_batches(max_chunksize=10_000)

    return placed.mapInArrow(pack, "id long, piece int, start long, length long, crc long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, end_id: int = 1, group: int = GROUP) -> DataFrame:
    """Tokenise, cut and pack: the columns of :func:`pieces` and the sequence and offset of each piece."""
    return packed(pieces(docs, tokenizer_path, id_col, text_col, limit, end_id), limit, group)
