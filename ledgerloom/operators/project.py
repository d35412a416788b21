"""Column bookkeeping: names, types and whole-frame rewrites in one projection."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fill_infinite, null_when_in
from ..functions.arithmetic import col, quote

# Characters kept in a cleaned column name (fixed value).
_CLEAN = re.compile("[^A-Za-z0-9_]+")

_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}
_FLOATING = {"float", "double"}


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str]) -> DataFrame:
    """Prefix every column but the ones to keep."""
    keep = set(keep)
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def clean_names(df: DataFrame) -> DataFrame:
    """Strip all but letters, digits and underscores from column names.

    Raises when two names fall together; Spark compares names without case.
    """
    names = [_CLEAN.sub("", c) for c in df.columns]
    seen: dict[str, str] = {}
    for before, after in zip(df.columns, names, strict=True):
        other = seen.setdefault(after.lower(), before)
        if other != before:
            raise ValueError(f"columns {other!r} and {before!r} would both become {after!r}")
    return df.toDF(*names)


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``'text'``, ``'numeric'`` (decimals too), ``'floating'`` or ``'boolean'`` columns."""
    wanted = {"text": {"string"}, "numeric": _NUMERIC, "floating": _FLOATING, "boolean": {"boolean"}}[kind]
    return [f.name for f in df.schema.fields if f.dataType.typeName() in wanted]


def columns_by_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def feature_columns(df: DataFrame, ids: Iterable[str]) -> list[str]:
    """All columns that are not identifiers or the label."""
    ids = set(ids)
    return [c for c in df.columns if c not in ids]


def null_sentinels(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column sentinel to null."""
    return df.withColumns({c: null_when_in(c, [v]) for c, v in values.items()})


def null_sentinel_everywhere(df: DataFrame, value, keep: Iterable[str] = ()) -> DataFrame:
    """One sentinel to null in every column of a matching type."""
    kind = "text" if isinstance(value, str) else "numeric"
    hit = set(columns_by_type(df, kind)) - set(keep)
    return df.select(*[null_when_in(c, [value]).alias(c) if c in hit else col(c) for c in df.columns])


def fill_null(df: DataFrame, value, columns: Sequence[str] | None = None) -> DataFrame:
    """Constant for nulls, in columns of the value's type."""
    return df.na.fill(value, subset=columns)


def fill_zero(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """0 for nulls in all columns but those of ``keep``; text columns get the text ``0``.

    A key without nulls belongs in ``keep``: filled, it no longer counts as what the rows are dealt by.
    """
    columns = [quote(c) for c in feature_columns(df, keep)]
    return df.na.fill(0, subset=columns).na.fill("0", subset=columns)


def fill_missing_label(df: DataFrame, label: str = "Missing", columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(label, subset=columns_by_type(df, "text") if columns is None else list(columns))


def infinite_to_zero(df: DataFrame) -> DataFrame:
    floating = set(columns_by_type(df, "floating"))
    return df.select(*[fill_infinite(c).alias(c) if c in floating else col(c) for c in df.columns])


def split_on_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a known label, and rows to score."""
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())
