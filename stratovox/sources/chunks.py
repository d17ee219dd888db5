"""Chunked stores of raw volumes, as a Spark data source: a partition for each chunk file, and boxes that open only the chunks they touch.

A store is a folder with a text file ``info`` (JSON: type, channels, and for each scale a key, size, voxel offset, chunk size and encoding, all
in the order x, y, z) and a folder for each scale, whose files are named by the chunk's bounds, ``x0-x1_y0-y1_z0-z1``. A file
holds the voxels in the order x, y, z, channel, x fastest, little-endian, plain or compressed by gzip (``.gz``). A chunk without a file
is background. Folders have to be mounted on all nodes.

``spark.read.format("chunks").load(path)``; options ``mip`` (the scale's number), ``low`` and ``high`` (a half-open box, "z,y,x"),
``background`` ("true": chunks without a file give rows of 0). Comparisons of z, y, x with numbers narrow the box too, where the session
hands filters to Python sources.
"""

from __future__ import annotations

import gzip
import json
import os
from collections.abc import Iterator
from itertools import product
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from stratovox.sources.volumes import AXES

#: Stored types and the columns that hold them; 64-bit unsigned ids keep their bits.
TYPES = {"uint8": "int", "int8": "int", "uint16": "int", "int16": "int", "uint32": "long", "int32": "int", "uint64": "long", "int64": "long", "float32": "float", "float64": "double"}


def folder(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"a chunked store is read from a mounted folder; {path} isn't one")
    return parts.path


def read_info(path: str) -> dict:
    with open(f"{folder(path)}/info") as f:
        return json.load(f)


def chunk_name(low: tuple[int, ...], high: tuple[int, ...]) -> str:
    """The file name of the box [low, high) given as z, y, x."""
    return "_".join(f"{a}-{b}" for a, b in reversed(list(zip(low, high))))


def scale_boxes(scale: dict, low: tuple[int, ...] | None = None, high: tuple[int, ...] | None = None) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
    """The chunks (low and high as z, y, x) of a scale that a box touches, by arithmetic: nothing is listed."""
    first, size, chunk = (tuple(reversed(x)) for x in (scale["voxel_offset"], scale["size"], scale["chunk_sizes"][0]))
    end = tuple(a + n for a, n in zip(first, size))
    low = tuple(max(a, b) for a, b in zip(first, low or first))
    high = tuple(min(a, b) for a, b in zip(end, high or end))
    if any(a >= b for a, b in zip(low, high)):
        return
    grid = [range((a - o) // c, (b - 1 - o) // c + 1) for a, b, o, c in zip(low, high, first, chunk)]
    for place in product(*grid):
        begin = tuple(o + k * c for o, k, c in zip(first, place, chunk))
        yield begin, tuple(min(b + c, e) for b, c, e in zip(begin, chunk, end))


class ChunkSource(DataSource):
    """The source ``chunks``."""

    @classmethod
    def name(cls) -> str:
        return "chunks"

    def schema(self) -> str:
        info = read_info(self.options["path"])
        channel = "c int, " if info.get("num_channels", 1) > 1 else ""
        return f"z int, y int, x int, {channel}value {TYPES[info['data_type']]}"

    def reader(self, schema) -> DataSourceReader:
        return ChunkReader(dict(self.options))


class Chunk(InputPartition):
    def __init__(self, low: tuple[int, ...], high: tuple[int, ...]):
        self.low, self.high = low, high


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.mip = folder(options["path"]), int(options.get("mip", 0))
        self.fill = options.get("background", "false").lower() == "true"
        box = [tuple(int(v) for v in options[k].split(",")) if options.get(k) else None for k in ("low", "high")]
        info = read_info(self.path)
        self.kind, self.channels, self.scale = info["data_type"], info.get("num_channels", 1), info["scales"][self.mip]
        first, size = (tuple(reversed(self.scale[k])) for k in ("voxel_offset", "size"))
        self.low, self.high = list(box[0] or first), list(box[1] or (a + n for a, n in zip(first, size)))

    def pushFilters(self, filters: list[Filter]):  # noqa: N802 (the interface's name)
        """Bounds of coordinates narrow the box; Spark still applies all filters."""
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and len(f.attribute) == 1 and f.attribute[0] in AXES:
                k = AXES.index(f.attribute[0])
                if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                    self.low[k] = max(self.low[k], f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                    self.high[k] = min(self.high[k], f.value + (not isinstance(f, LessThan)))
            yield f

    def partitions(self):
        return [Chunk(*box) for box in scale_boxes(self.scale, tuple(self.low), tuple(self.high))]

    def read(self, partition: Chunk | None):
        if partition is None:  # Spark's stand-in where there are no partitions
            return
        size = tuple(b - a for a, b in zip(partition.low, partition.high))
        raw = self._bytes(f"{self.path}/{self.scale['key']}/{chunk_name(partition.low, partition.high)}")
        kind = np.dtype(self.kind).newbyteorder("<")
        if raw is None:
            if not self.fill:
                return
            raw = bytes(kind.itemsize * self.channels * size[0] * size[1] * size[2])
        values = np.frombuffer(raw, kind).reshape(self.channels, *size)
        cut = tuple(slice(max(lo, a) - a, min(hi, b) - a) for a, b, lo, hi in zip(partition.low, partition.high, self.low, self.high))
        values = values[(slice(None), *cut)]
        start = [a + c.start for a, c in zip(partition.low, cut)]
        column = {"uint64": np.int64, "uint32": np.int64, "float32": np.float32, "float64": np.float64, "int64": np.int64}.get(self.kind, np.int32)
        for z in range(values.shape[1]):  # a batch for each slice of the chunk
            c, y, x = (i.ravel() for i in np.indices((values.shape[0], *values.shape[2:]), np.int32))
            place = [np.full(len(y), z + start[0], np.int32), y + np.int32(start[1]), x + np.int32(start[2]), *([c] if self.channels > 1 else [])]
            names = [*AXES, *(["c"] if self.channels > 1 else []), "value"]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*place, values[:, z].ravel().astype(column))], names=names)

    @staticmethod
    def _bytes(path: str) -> bytes | None:
        if os.path.exists(path):
            with open(path, "rb") as f:
                return f.read()
        if os.path.exists(f"{path}.gz"):
            with gzip.open(f"{path}.gz") as f:
                return f.read()
        return None


def write_chunks(volume: DataFrame, path: str, value: str, kind: str, chunk: tuple[int, int, int], size: tuple[int, int, int], channels: int = 1, offset: tuple[int, int, int] = (0, 0, 0),
                 compressed: bool = True, key: str = "0", append: bool = False) -> int:
    """Write a volume as a scale of a chunked store, a task a chunk at a time; the number of chunk files. Sizes and offsets are z, y, x.

    Missing rows are background, as are chunks without any row, which get no file. ``append``: one more scale of a store that is there. A chunk is written
    beside its place and renamed, so a repeated task does no harm. Rows outside of [offset, offset + size) are an error.
    """
    top = folder(path)
    os.makedirs(f"{top}/{key}", exist_ok=append)
    scale = {"key": key, "size": list(reversed(size)), "voxel_offset": list(reversed(offset)), "chunk_sizes": [list(reversed(chunk))], "encoding": "raw", "resolution": [1, 1, 1]}
    channel = F.col("c") if channels > 1 else F.lit(0)
    rows = volume.select(*(F.col(a).cast("int").alias(a) for a in AXES), channel.cast("int").alias("c"), F.col(value).alias("v"))
    inside = F.lit(True)
    for a, o, n in zip(AXES, offset, size):
        inside = inside & F.col(a).between(o, o + n - 1)
    place = [F.when(inside, F.expr(f"({a} - {o}) div {c}")).otherwise(F.raise_error(F.lit("a voxel outside of the store")).cast("long")).alias(f"k{a}") for a, o, c in zip(AXES, offset, chunk)]
    dtype, end = np.dtype(kind).newbyteorder("<"), [o + n for o, n in zip(offset, size)]

    def put(part: pd.DataFrame) -> pd.DataFrame:
        low = [int(part[f"k{a}"].iloc[0]) * c + o for a, c, o in zip(AXES, chunk, offset)]
        high = [min(b + c, e) for b, c, e in zip(low, chunk, end)]
        out = np.zeros((channels, *(b - a for a, b in zip(low, high))), dtype)
        out[(part["c"], *(part[a] - k for a, k in zip(AXES, low)))] = part["v"].to_numpy().astype(dtype)
        name = f"{top}/{key}/{chunk_name(tuple(low), tuple(high))}" + (".gz" if compressed else "")
        beside = f"{top}/{key}/.{os.getpid()}-{os.path.basename(name)}"
        with open(beside, "wb") as f:
            f.write(gzip.compress(out.tobytes(), mtime=0) if compressed else out.tobytes())
        os.replace(beside, name)
        return pd.DataFrame({"n": [1]})

    n = rows.select("*", *place).groupBy("kz", "ky", "kx").applyInPandas(put, "n long").agg(F.sum("n")).first()[0] or 0
    info = read_info(path) if append else {"type": "segmentation" if kind.startswith("u") and kind != "uint8" else "image", "data_type": kind, "num_channels": channels, "scales": []}
    info["scales"].append(scale)
    with open(f"{top}/info", "w") as f:
        json.dump(info, f)
    return n


def read_chunks(spark: SparkSession, path: str, mip: int = 0, low: tuple[int, ...] | None = None, high: tuple[int, ...] | None = None, background: bool = False) -> DataFrame:
    """A scale of a chunked store, or a box of it, as ``z, y, x`` (``c``) and ``value``."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # Spark refuses sources that take filters without it
    spark.dataSource.register(ChunkSource)
    reader = spark.read.format("chunks").option("mip", mip).option("background", str(background).lower())
    for name, bound in (("low", low), ("high", high)):
        if bound is not None:
            reader = reader.option(name, ",".join(map(str, bound)))
    return reader.load(path)


def converted(spark: SparkSession, source: str, target: str, chunk: tuple[int, int, int], mip: int = 0, compressed: bool = True) -> int:
    """One scale of a store copied into a new store of other chunks."""
    info = read_info(source)
    scale = info["scales"][mip]
    size, offset = (tuple(reversed(scale[k])) for k in ("size", "voxel_offset"))
    return write_chunks(read_chunks(spark, source, mip), target, "value", info["data_type"], chunk, size, info.get("num_channels", 1), offset, compressed)


__all__ = ["ChunkSource", "chunk_name", "converted", "read_chunks", "read_info", "scale_boxes", "write_chunks"]
