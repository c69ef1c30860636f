"""Shared storage: where checkpoints and intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shopwright-")
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder that does not exist yet, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of executors."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def discard_at_end(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path`` when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows as a table in the shared folder, read back; it is deleted when the application ends.

    Unlike a checkpoint, the table has a size Spark knows when it plans a join,
    and carries no partitioning into it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    discard_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
