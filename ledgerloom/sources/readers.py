"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arithmetic import key_digest


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    key: str | None = None,
) -> DataFrame:
    """CSV with a header.

    Pass a schema on large inputs: inference reads the files twice.  ``key``
    names the column that identifies a row; it is moved to the front and rows
    stay addressable by it, there is no separate index.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if key is None:
        return df
    return df.select(key, *[c for c in df.columns if c != key])


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan, split on ``column`` when one is given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A relational table, read by many tasks when ``column`` is a numeric key.

    Without ``bounds`` the database is asked for the smallest and largest key.
    Connection details belong in ``properties``, never in code.
    """
    properties = properties or {}
    if column is not None and bounds is None:
        query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) span"
        span = spark.read.format("jdbc").options(**jdbc_options(url, query), **properties).load().first()
        if span[0] is not None:
            bounds = (int(span[0]), int(span[1]))
    if bounds is None:
        options = jdbc_options(url, table)
    else:
        options = jdbc_options(
            url,
            table,
            column,
            bounds[0],
            bounds[1] + 1,
            partitions or spark.sparkContext.defaultParallelism,
        )
    return spark.read.format("jdbc").options(**options, **properties).load()


def row_cap(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order``, for debug runs; all rows for ``None``.

    Sort and limit together become a top-k per task and one small merge.
    """
    return df if n is None else df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 1001) -> DataFrame:
    """``n`` rows picked by a seeded digest of the key, the same ones every run and in any engine.

    Every task passes on its ``n`` first rows only.
    """
    return df.orderBy(key_digest(key, seed), *key).limit(n)
