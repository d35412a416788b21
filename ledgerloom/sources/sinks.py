"""Snapshots, CSV output and stored parameters."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(
    df: DataFrame,
    path: str,
    label: str | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Write a Parquet snapshot.

    With ``label`` the rows are laid out by ``split``: ``train`` where the label
    is known and ``score`` where it is null, so either side is read alone.
    """
    if label is not None:
        split = F.when(F.col(label).isNotNull(), F.lit("train")).otherwise(F.lit("score"))
        df, partition_by = df.withColumn("split", split), ["split", *partition_by]
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_snapshot(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read a snapshot back; ``split`` prunes to one of its two sides."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split).drop("split")


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV part per task, each with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """Keep a small parameter set as one JSON document."""
    text = json.dumps(params, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
