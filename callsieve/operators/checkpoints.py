"""Materialising small intermediate results, and checking their size."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 128  # per row of a broadcast hash table


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure checkpoints have a home: the session's own setting, or on a local master a new folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        # The executors of a local cluster are processes of their own, as on a real one.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="callsieve-checkpoint-")
    sc.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the checkpoint folder."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def remove_checkpoints(spark: SparkSession) -> None:
    """Delete this session's checkpoint files, once no result that was built on them is needed any more."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def is_written(spark: SparkSession, folder: str) -> bool:
    """Whether Spark has finished writing a table to `folder`."""
    return exists(spark, f"{folder}/_SUCCESS")


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def size_in_bytes(df: DataFrame) -> int:
    """What all rows of `df` take as a broadcast hash table, at most; 0 for no rows. This computes `df`."""
    size = F.lit(ROW_OVERHEAD_BYTES)
    for name in df.columns:
        # A key column is held twice: in the key and in the row.
        size = size + 2 * F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
