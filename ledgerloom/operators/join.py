"""Joins and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import col


def attach(parent: DataFrame, *tables: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left-join per-key tables to their parent on one key.

    All tables are partitioned by that key after aggregation, so Spark moves
    each of them at most once.
    """
    return reduce(lambda left, right: left.join(right, on, "left"), tables, parent)


def join_suffixed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Equi-join where columns present on both sides get a suffix."""
    on = list(on)
    # Spark compares names without case.
    clash = ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - {c.lower() for c in on}

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select(*[col(c).alias(c + suffix) if c.lower() in clash else col(c) for c in df.columns])

    return renamed(left, suffixes[0]).join(renamed(right, suffixes[1]), on, how)


def exists_flag(df: DataFrame, other: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """1 where the key occurs in ``other``, else 0."""
    keys = other.select(*on).distinct().withColumn(out, F.lit(1))
    return df.join(keys, list(on), "left").withColumn(out, F.coalesce(out, F.lit(0)))


def align(base: DataFrame, other: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Put columns of a frame with the same key beside these."""
    return base.join(other.select(*on, *[col(c) for c in columns]), list(on), "left")


def union_all_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_rows(df: DataFrame, n: int, by: Sequence) -> DataFrame:
    return df.orderBy(*by).limit(n)


def semi_join_top(
    df: DataFrame, key: str, value: str, n: int, out: str = "mean"
) -> DataFrame:
    """Rows whose key is among the ``n`` with the largest mean value."""
    best = top_rows(df.groupBy(key).agg(F.avg(value).alias(out)), n, [F.desc(out), F.asc(key)])
    return df.join(best, key, "left_semi")
