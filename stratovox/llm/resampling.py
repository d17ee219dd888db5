"""Importance resampling of documents towards a target's distribution of hashed word runs.

Features are runs of 1 to ``ngrams`` words; a feature's bucket is the crc32 of its bytes modulo ``buckets``. The CRCs of a batch are
computed in matrices: features of equal length form the rows of a two-dimensional array of bytes, repeated rows are set aside,
the CRCs of all rows take one column after another, and buckets are scattered back to the features' places.

Each task returns one count a bucket, so the two distributions are at most ``buckets`` rows each. A document's weight is its features'
mean gain (log ratio of the smoothed distributions, in thousandths, floored); noise from a hash of its id is added (the Gumbel
top-k draw), and the highest scores are drawn without replacement. The scores are whole numbers of a bounded range, so their histogram
gives the least drawn score; only documents from there on are sorted, in ranges of (score, id), to be numbered.

Defined cases: null and empty texts have no features and weight 0; a null id counts as empty text in the hash, and stands last among ties;
repeated rows are documents of their own (and draw together, as their noise is equal); an empty target or corpus counts as
zero in every bucket; other columns are ignored or, by ``columns``, carried along.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratovox.llm.common import saved
from stratovox.llm.decontaminate import NORMAL
from stratovox.llm.words import Words, slices, split_words

#: Bytes of text whose features are hashed at once.
PART_BYTES = 8 << 20
#: Features of more bytes than this take zlib's loop over their bytes: as single rows they gain nothing from columns.
LONG = 2048
#: The gains of all buckets are broadcast, so their number is bounded.
MOST_BUCKETS = 1 << 20


def crc_table(polynomial: int = 0xEDB88320) -> np.ndarray:
    """The CRC of every byte, by eight steps of the polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(polynomial), c >> np.uint32(1))
    return c


_TABLE = crc_table()


def crcs(rows: np.ndarray) -> np.ndarray:
    """The crc32 of each row of a matrix of bytes, all rows updated column by column."""
    out = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        out = _TABLE[(out ^ column) & np.uint32(0xFF)] ^ (out >> np.uint32(8))
    return ~out


def feature_buckets(words: Words, ngrams: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every run of 1 to ``ngrams`` words, and the text it belongs to."""
    flat, begin, end = words.spaced()
    start, stop, text = [], [], []
    for n in range(1, ngrams + 1):
        last = np.arange(n - 1, len(begin))
        first = last - (n - 1)
        same = words.text[first] == words.text[last]
        start.append(begin[first[same]])
        stop.append(end[last[same]])
        text.append(words.text[first[same]])
    start, stop, text = np.concatenate(start), np.concatenate(stop), np.concatenate(text)
    length = stop - start
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order], prepend=-1))
    out = np.zeros(len(start), np.int64)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        at, size = order[a:b], int(length[order[a]])
        if size > LONG:
            out[at] = [zlib.crc32(flat[i : i + size]) for i in start[at].tolist()]
            continue
        matrix = sliding_window_view(flat, size)[start[at]]
        rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(at), [None, pa.py_buffer(matrix)]).dictionary_encode()
        distinct = np.frombuffer(rows.dictionary.buffers()[1], np.uint8, len(rows.dictionary) * size).reshape(-1, size)
        out[at] = crcs(distinct)[rows.indices.to_numpy()]
    return out % buckets, text


def distribution(texts: DataFrame, text_col: str, ngrams: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, 0, PART_BYTES):
            total += np.bincount(feature_buckets(split_words(part.column(0), NORMAL), ngrams, buckets)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: the log ratio of the two smoothed shares, in thousandths, floored."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def _free(name: str, columns: list[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name = "_" + name
    return name


_WEIGHT = T.StructType().add("n_words", T.LongType()).add("n_features", T.LongType()).add("weight", T.LongType())


def weighted(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text", columns: list[str] | None = None,
             ngrams: int = 1, buckets: int = 10_000) -> tuple[DataFrame, str]:
    """``columns`` of ``docs`` (all by default) and a struct of ``n_words, n_features, weight``, whose name is the second result."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets have to be between 1 and {MOST_BUCKETS}")
    gain = docs.sparkSession.sparkContext.broadcast(gains(distribution(docs, text_col, ngrams, buckets), distribution(target, target_text_col, ngrams, buckets)))
    columns = docs.columns if columns is None else columns
    name, place = _free("resampling", columns), len(columns)
    fields = [docs.schema[c] for c in columns]

    def weigh(batches):
        for part in slices(batches, place, PART_BYTES):
            words = split_words(part.column(place), NORMAL)
            bucket, text = feature_buckets(words, ngrams, buckets)
            n = np.bincount(text, minlength=words.texts)
            total = np.zeros(words.texts, np.int64)
            np.add.at(total, text, gain.value[bucket])
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)
            found = pa.StructArray.from_arrays([pa.array(words.per_text().astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(mean)], names=_WEIGHT.names)
            yield pa.RecordBatch.from_arrays([*part.columns[:place], found], names=[*columns, name])

    rows = docs.select(*columns, F.col(text_col).alias(_free("text", columns)))
    return rows.mapInArrow(weigh, T.StructType([*fields, T.StructField(name, _WEIGHT)])), name


def noise(id_col: str, seed: str) -> Column:
    """Gumbel noise in thousandths, floored, from the first 32 bits of a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", columns: list[str] | None = None,
              ngrams: int = 1, buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: str = "2024") -> tuple[DataFrame, str]:
    """``columns`` of all rows of ``docs`` (with ``id_col``), and a struct ``n_words, n_features, weight, score, rank``, whose name is the second result.

    Of the N documents with ``min_words`` words at least, the ``percent`` N / 100 (floored) with the highest scores are drawn: their ranks go from
    1; other ranks are null.
    """
    columns = docs.columns if columns is None else columns
    rows, name = weighted(docs, target, text_col, target_text_col, columns, ngrams, buckets)
    value = F.col(name)
    rows = saved(rows.withColumn(name, value.withField("score", value["weight"] + noise(id_col, seed))), "resampling")
    # scores lie between the least and the greatest gain plus noise: tens of thousands of values at any size
    histogram = rows.where(value["n_words"] >= min_words).groupBy(value["score"].alias("score")).agg(F.count("*").alias("n")).toPandas().sort_values("score", ascending=False)
    wanted = percent * int(histogram["n"].sum()) // 100
    reached = histogram[histogram["n"].cumsum() >= wanted] if wanted else histogram[:0]
    unranked = lambda df: df.withColumn(name, value.withField("rank", F.lit(None).cast("long")))
    if not wanted:
        return unranked(rows), name
    in_reach = (value["n_words"] >= min_words) & (value["score"] >= int(reached["score"].iloc[0]))
    order = [F.desc("score_"), F.asc_nulls_last("id_")]
    ranges = rows.where(in_reach).withColumns({"score_": value["score"], "id_": F.col(id_col)}).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(ranges.drop("score_", "id_").withColumn("place_", F.monotonically_increasing_id()), "resampling-ranges")
    part = F.shiftright("place_", 33)
    before = placed.groupBy(part.alias("part_")).agg(F.count("*").alias("n_"))
    # a row for each range, so as many as tasks
    before = before.withColumn("before_", F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))).drop("n_")
    rank = F.coalesce(F.col("before_"), F.lit(0)) + F.col("place_").bitwiseAND((1 << 33) - 1) + 1
    ranked = placed.withColumn("part_", part).join(F.broadcast(before), "part_").withColumn("rank_", rank)
    ranked = ranked.withColumn(name, value.withField("rank", F.when(F.col("rank_") <= wanted, F.col("rank_")).cast("long"))).select(*rows.columns)
    return ranked.unionByName(unranked(rows.where(~in_reach))), name


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    found, name = resampled(docs, target, **options)
    return found.where(F.col(name)["rank"].isNotNull()).drop(name)
