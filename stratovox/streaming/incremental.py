"""Incremental work: contingency counts over arriving blocks, and resumable bookkeeping of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratovox.operators.grid import running_before
from stratovox.plans.scratch import scratch


def block_stream(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 4) -> DataFrame:
    """A stream over the Parquet files of stored blocks, some files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def counted_stream(stream: DataFrame, a: str, b: str) -> DataFrame:
    """Running pair counts; the state is one row for each pair of labels, not for each voxel."""
    return stream.groupBy(a, b).agg(F.count("*").alias("n"))


def stream_result(stream: DataFrame, name: str) -> DataFrame:
    """Run a complete-mode stream over all that is there, with a checkpoint in the shared folder; its last result as a table."""
    spark = stream.sparkSession
    out = scratch(spark, name)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode("complete").option("checkpointLocation", f"{out}-state").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    found = spark.read.parquet(out)
    return found.where(F.col("batch") == found.agg(F.max("batch")).first()[0]).drop("batch")


def upserted(old: DataFrame, new: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key. Of several new rows of a key the one with the greatest ``newest`` (a time or
    number) stays, on ties that with the greatest hash, so a repeated run gives the same row."""
    both = old.withColumn("new_", F.lit(0)).unionByName(new.withColumn("new_", F.lit(1)))
    order = [F.desc("new_"), *([F.desc(newest)] if newest else []), F.desc(F.xxhash64(*old.columns))]
    return both.withColumn("r_", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("r_ = 1").drop("r_", "new_")


def resumed_offsets(sizes: DataFrame, merged: DataFrame, start: int = 1) -> DataFrame:
    """``idx, offset`` of the blocks that aren't merged yet: ids go on, in the order of ``idx``, after those that merged blocks (``idx, max_id``) took up."""
    next_id = merged.agg((F.coalesce(F.sum("max_id"), F.lit(0)) + start).alias("next_"))
    rest = running_before(sizes.join(merged.select("idx"), "idx", "left_anti"), "idx", "max_id", "before_id")
    return rest.join(F.broadcast(next_id)).select("idx", (F.col("before_id") + F.col("next_")).cast("long").alias("offset"))


def pending(blocks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Blocks that aren't done yet: a restarted run only takes these up."""
    return blocks.join(done.select(key), key, "left_anti")
