"""Storage every executor can reach, for checkpoints and scratch tables."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.path.join(tempfile.gettempdir(), "ledgerloom-checkpoints")
    os.makedirs(folder, exist_ok=True)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later steps see one fixed result."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what was written to a path of ``scratch_path``, once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getParent().getName() != "scratch":
        raise ValueError(f"not a scratch path: {path}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free_files(spark: SparkSession) -> None:
    """Let go of the shuffle files, and checkpoints where Spark cleans those, of frames that nothing refers to.

    Spark removes such files only after the driver has collected its garbage, which a driver
    with memory to spare may not do for the whole of a job.  Files still in use are not touched.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
