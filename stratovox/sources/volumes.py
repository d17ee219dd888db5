"""Volumes as voxel tables: one row for each voxel, ``z, y, x`` and values.

A missing row is background (0). Regions of interest are predicates on the coordinates, so they reach the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
HEIGHT, WIDTH = 20, 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A volume of 20 by 25 voxels a slice from ``events``: labels ``seg`` and ``gt``, intensity ``img``, mask ``msk``."""
    e = table(spark, sf_dir, "events").select(
        F.expr("cast(event_id div 500 as int)").alias("z"), F.expr("cast((event_id div 25) % 20 as int)").alias("y"),
        F.expr("cast(event_id % 25 as int)").alias("x"), F.col("user_id").alias("seg"),
        F.least(F.col("value").cast("double") / F.lit(100.0), F.lit(1.0)).alias("img"), (F.col("event_type") != "error").alias("msk"),
    )
    gt = F.expr("cast(1 + (z div 4) * 4 + (y div 10) * 2 + (x div 13) as bigint)")
    return e.select("z", "y", "x", "seg", gt.alias("gt"), "img", "msk")


def region(volume: DataFrame, low: tuple[int, ...], high: tuple[int, ...]) -> DataFrame:
    """The half-open box [low, high); the bounds are pushed down to a stored volume's scan."""
    for axis, a, b in zip(AXES, low, high):
        volume = volume.where((F.col(axis) >= a) & (F.col(axis) < b))
    return volume


def dense(volume: DataFrame, low: tuple[int, ...] | None = None, high: tuple[int, ...] | None = None) -> DataFrame:
    """The volume with a row for every voxel of the box [low, high), by default its bounding box: missing rows are background
    (0, false, or null for other types). A volume that has all rows is returned as it is; finding out reads only coordinates.
    """
    bounds = volume.agg(F.count("*").alias("n"), *(f(a).alias(f"{k}{a}") for a in AXES for k, f in (("low", F.min), ("high", F.max)))).first()
    if low is None or high is None:
        if not bounds["n"]:
            return volume
        low, high = tuple(bounds[f"low{a}"] for a in AXES), tuple(bounds[f"high{a}"] + 1 for a in AXES)
    size = [h - k for k, h in zip(low, high)]
    if bounds["n"] == size[0] * size[1] * size[2] and all(bounds[f"low{a}"] >= k and bounds[f"high{a}"] < h for a, k, h in zip(AXES, low, high)):
        return volume
    kinds = dict(volume.dtypes)
    place = [F.expr(f"id div {size[1] * size[2]}"), F.expr(f"id div {size[2]} % {size[1]}"), F.expr(f"id % {size[2]}")]
    cells = volume.sparkSession.range(size[0] * size[1] * size[2]).select(*((p + k).cast(kinds[a]).alias(a) for p, k, a in zip(place, low, AXES)))
    empty = {c: F.lit(False) if kinds[c] == "boolean" else F.lit(0).cast(kinds[c]) for c in volume.columns if re.match(r"boolean|(tiny|small|big)?int|float|double|decimal", kinds[c])}
    joined = cells.join(volume.withColumn("row_", F.lit(True)).hint("merge"), list(AXES), "left")
    return joined.select(*(F.when(F.col("row_"), F.col(c)).otherwise(empty[c]).alias(c) if c in empty and c not in AXES else F.col(c) for c in volume.columns))


def write_blocks(volume: DataFrame, path: str, block: tuple[int, int, int]) -> None:
    """Store a volume as Parquet, a folder for each block of the grid; a later region read prunes folders."""
    keys = [F.expr(f"cast({axis} div {size} as int)").alias(f"b{axis}") for axis, size in zip(AXES, block)]
    out = volume.select("*", *keys)
    names = [f"b{axis}" for axis in AXES]
    out.repartition(*names).sortWithinPartitions(*AXES).write.partitionBy(*names).parquet(path)


def read_blocks(spark: SparkSession, path: str, block: tuple[int, int, int], low: tuple[int, ...] | None = None, high: tuple[int, ...] | None = None) -> DataFrame:
    """A stored volume, or a box of it: only the blocks that the box touches are listed and read."""
    out = spark.read.parquet(path)
    if low is not None and high is not None:
        for axis, size, a, b in zip(AXES, block, low, high):
            out = out.where(F.col(f"b{axis}").between(a // size, (b - 1) // size))
        out = region(out, low, high)
    return out.drop(*(f"b{axis}" for axis in AXES))


def one_channel(volume: DataFrame, value: str, channel: str = "c") -> DataFrame:
    """The mean over channels, cast back to the value's type."""
    kind = dict(volume.dtypes)[value]
    return volume.groupBy(*AXES).agg(F.avg(value).cast(kind).alias(value))


#: Readers by a path's suffix; other paths are Parquet.
FORMATS = {"parquet": "parquet", "orc": "orc", "json": "json", "csv": "csv"}


def read_volume(spark: SparkSession, path: str, schema: str | None = None, drop_channel: str | None = None) -> DataFrame:
    """A stored voxel table by its suffix (Parquet, ORC, JSON, CSV with a header); ``drop_channel`` names a value whose channels are averaged."""
    kind = FORMATS.get(path.rstrip("/").rsplit(".", 1)[-1].lower(), "parquet")
    reader = spark.read.format(kind).option("header", True)
    found = (reader.schema(schema) if schema else reader).load(path)
    return one_channel(found, drop_channel) if drop_channel else found


def write_volume(volume: DataFrame, path: str, slices: int | None = None) -> None:
    """Store a voxel table by the path's suffix, a folder for each slice; ``slices``: only so many from the first (a preview)."""
    kind = FORMATS.get(path.rstrip("/").rsplit(".", 1)[-1].lower(), "parquet")
    rows = volume if slices is None else volume.where(F.col("z") < slices)
    rows.write.partitionBy("z").option("header", True).format(kind).save(path)


def listed_paths(spark: SparkSession, text: str) -> list[str]:
    """Paths of an @-separated list of paths and patterns, in order, as the file system of each knows them."""
    out = []
    for pattern in filter(None, text.split("@")):
        place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
        out += sorted(str(f.getPath()) for f in found or ())
    return out


def image_stack(spark: SparkSession, pattern: str) -> DataFrame:
    """Files of a stack as bytes; ``z`` is a file's place in the order of paths. Only the paths are ranked, on the driver, which lists them anyway."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    ranks = [(r.path, z) for z, r in enumerate(files.select("path").orderBy("path").toLocalIterator())]
    return files.join(spark.createDataFrame(ranks, "path string, z int"), "path").select("z", "path", "content")


def colour_ids(red: Column, green: Column, blue: Column) -> Column:
    """The id that a colour of an exported segmentation stands for."""
    return (red * 65536 + green * 256 + blue).cast("long")


def grid_of_name(name: Column) -> list[Column]:
    """Grid coordinates that a chunk's file name carries."""
    pattern = r"chunk_z(\d+)_y(\d+)_x(\d+)\."
    return [F.regexp_extract(name, pattern, k + 1).cast("int").alias(f"c{axis}") for k, axis in enumerate(AXES)]
