"""Merging block segmentations over their overlaps into one global labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratovox.operators.components import components
from stratovox.operators.grid import running_before
from stratovox.operators.labels import joined_by_label
from stratovox.sources.volumes import AXES


def offsets(block_sizes: DataFrame, first: int = 1) -> DataFrame:
    """``idx, max_id, offset``: what is added to a block's ids so that those of all blocks differ."""
    out = running_before(block_sizes.select("idx", "max_id"), "idx", "max_id", "offset")
    return out.withColumn("offset", F.col("offset") + first)


def local_ids(rows: DataFrame, label: str) -> DataFrame:
    """Replace a label by its rank among the labels of the block (0 stays 0): a block's own ids, 1 to n."""
    ranks = rows.where(F.col(label) != 0).select("idx", label).distinct().withColumn("id", F.row_number().over(Window.partitionBy("idx").orderBy(label)).cast("long"))
    return joined_by_label(rows, label, ranks, "idx").select("idx", *AXES, F.coalesce("id", F.lit(0)).alias("id"))


def block_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("idx").agg(F.max("id").alias("max_id"))


def with_offsets(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Global ids: the offset is added where the id isn't 0."""
    joined = rows.join(table.select("idx", "offset"), "idx")
    return joined.select("idx", *AXES, F.when(F.col("id") != 0, F.col("id") + F.col("offset")).otherwise(F.lit(0)).alias("id"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``i, j, a, b, n``: voxels that block i calls a and block j (i < j) calls b, both not 0; blocks meet by coordinates."""
    held = rows.where(F.col("id") != 0)
    left = held.select(F.col("idx").alias("i"), *AXES, F.col("id").alias("a"))
    right = held.select(F.col("idx").alias("j"), *AXES, F.col("id").alias("b"))
    return left.join(right, list(AXES)).where("i < j").groupBy("i", "j", "a", "b").agg(F.count("*").alias("n"))


def selected(counts: DataFrame, min_voxels: int = 5, share_local: float = 0.5, share_global: float = 0.5, max_voxels: float = 1.5e6) -> DataFrame:
    """Pairs that are taken for one object: enough common voxels, and a large enough share of either side."""
    of = lambda side: F.sum("n").over(Window.partitionBy("i", "j", side))
    totals = counts.select("*", of("a").alias("total_a"), of("b").alias("total_b"))
    n = F.col("n").cast("double")
    small = (n / F.col("total_a") < share_local) & (n / F.col("total_b") < share_global)
    return totals.where((F.col("n") >= min_voxels) & (F.col("total_b") <= max_voxels) & ~small)


def representatives(pairs: DataFrame) -> DataFrame:
    """``(id, rep)``: for each id of a pair the least id of its pool."""
    found = components(pairs, "a", "b")
    found = found.union(found.select(F.col("root"), "root").distinct())
    return found.select(F.col("node").alias("id"), F.col("root").alias("rep"))


def applied(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """The global volume: ids replaced by their representatives; where blocks overlap, the block of the greatest index decides."""
    named = joined_by_label(rows, "id", reps.where("id <> 0")).withColumn("id", F.coalesce("rep", "id"))
    return named.groupBy(*AXES).agg(F.max_by("id", "idx").alias("id"))
