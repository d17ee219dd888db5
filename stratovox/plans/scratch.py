"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where a local session doesn't set it (tests, a laptop), a temporary folder is chosen and recorded.

    On a cluster executors can't see the driver's temporary folder, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage, survives lost executors and keeps later passes from computing twice.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`saved` that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
