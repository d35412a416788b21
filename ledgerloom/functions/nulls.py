"""Null and sentinel rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arithmetic import ColumnLike, col


def nan_to_null(c: ColumnLike) -> Column:
    return F.nanvl(col(c), F.lit(None).cast("double"))


def null_when_in(c: ColumnLike, values: Iterable) -> Column:
    """Listed values become null."""
    values = list(values)
    c = col(c)
    return F.nullif(c, F.lit(values[0])) if len(values) == 1 else F.when(~c.isin(values), c)


def null_below(c: ColumnLike, limit) -> Column:
    """Values under ``limit`` become null."""
    c = col(c)
    return F.when(c >= F.lit(limit), c)


def fill_infinite(c: ColumnLike, value: float = 0.0) -> Column:
    """Plus and minus infinity become ``value``; NaN and null are left alone."""
    c = col(c)
    return F.when(F.abs(c) == F.lit(float("inf")), F.lit(value)).otherwise(c)


def not_equal_keep_null(c: ColumnLike, value) -> Column:
    """``c != value`` where a null counts as different."""
    return ~col(c).eqNullSafe(F.lit(value))


def is_member(c: ColumnLike, values: Iterable) -> Column:
    """Membership where a null is not a member."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))
