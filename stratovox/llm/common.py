"""Small helpers that the training-data operators share."""

from __future__ import annotations

import os
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratovox.plans.scratch import saved, scratch

__all__ = ["LOWER", "PlaceMap", "crc_bucket", "local_path", "place_map", "required", "runs", "saved", "scratch", "shared_folder", "table"]

#: Upper-case ASCII letters to lower case, all other bytes unchanged.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named Parquet table, opened by Spark (any store that Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_path(uri: str) -> str:
    """The path by which Python workers open a file of the shared folder.

    The folder has to be mounted on all nodes; other schemes are refused with a clear error
    (operators that only exchange tables don't call this and run on any store).
    """
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"this operator writes plain files and needs a mounted shared folder; {uri} isn't one")
    return parts.path


#: A file that the driver writes into a shared folder; a task that doesn't see it isn't looking at that folder.
MARK = "driver-was-here"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared one, for plain files, that :func:`required` recognises in tasks."""
    folder = scratch(spark, name)
    os.makedirs(local_path(folder))
    with open(f"{local_path(folder)}/{MARK}", "w"):
        pass
    return folder


def required(folder: str) -> str:
    """The path of a shared folder; an error on a node that doesn't see what the driver wrote there."""
    path = local_path(folder)
    if not os.path.exists(f"{path}/{MARK}"):
        raise FileNotFoundError(f"{path} isn't the driver's folder on this node; spark.checkpoint.dir has to be mounted everywhere")
    return path


def crc_bucket(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null ids count as remainder 1)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(1))


def runs(batches, n_keys: int):
    """Tables of the rows that agree in the first ``n_keys`` columns, from batches that are sorted by them; single rows are left out."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:n_keys]])
        if held:
            last = np.array([held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(n_keys)])
            if (last != keys[:, 0]).any():
                if sum(b.num_rows for b in held) > 1:
                    yield pa.Table.from_batches(held)
                held = []
        cuts = np.nonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))[0] + 1
        ends = np.concatenate([cuts, [batch.num_rows]])
        starts = np.concatenate([[0], cuts])
        if held and len(cuts):
            yield pa.Table.from_batches([*held, batch.slice(0, int(cuts[0]))])
            held = []
            starts, ends = starts[1:], ends[1:]
        for a, b in zip(starts[:-1][ends[:-1] - starts[:-1] > 1].tolist(), ends[:-1][ends[:-1] - starts[:-1] > 1].tolist()):
            yield pa.Table.from_batches([batch.slice(a, b - a)])
        held.append(batch.slice(int(starts[-1]), int(ends[-1] - starts[-1])))
    if sum(b.num_rows for b in held) > 1:
        yield pa.Table.from_batches(held)


class PlaceMap:
    """Places of pairs of longs in a map of 2^26 bits; the map is 8 MB at any size of the input."""

    BITS = 26

    @classmethod
    def place(cls, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return mixed >> np.uint64(64 - cls.BITS)

    @classmethod
    def marked(cls, bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = cls.place(a, b)
        return bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)


def place_map(pairs: DataFrame):
    """A broadcast map of the pairs (columns a and b, longs without nulls), and how to read it.

    It lets a scan drop most rows that an exact join would drop later; pairs that share a place pass it.
    """

    def marks(batches):
        bits = np.zeros(1 << (PlaceMap.BITS - 6), np.uint64)
        for batch in batches:
            at = PlaceMap.place(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            np.bitwise_or.at(bits, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        word = np.nonzero(bits)[0]
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(bits[word].view(np.int64))], names=["word", "bits"])

    found = pairs.select("a", "b").mapInArrow(marks, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    bits = np.zeros(1 << (PlaceMap.BITS - 6), np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return pairs.sparkSession.sparkContext.broadcast(bits.view(np.uint64)), PlaceMap
