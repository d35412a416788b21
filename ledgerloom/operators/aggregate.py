"""Spec-driven aggregation: ``{column: [functions]}`` to one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import col, quote, sql_literal
from ..functions.nulls import nan_to_null
from .lookup import HOT_ROWS, dealt, hot_salts
from .project import columns_by_type
from .ranking import group_quantiles

Spec = Mapping[str, Sequence[str]]


# Squared deviations summing to less than this are rounding noise (fixed value).
_NO_SPREAD = "1e-14D"

# A sum over nothing is 0, a spread over one value is null, skewness is
# bias-adjusted and 0 for a constant group, and infinities that cancel give
# null: the rules of dataframe libraries.  {c} is the column and {f} an optional
# filter clause.
_TEMPLATES = {
    "min": "min({c}){f}",
    "max": "max({c}){f}",
    "mean": "nanvl(avg({c}){f}, CAST(NULL AS DOUBLE))",
    "sum": "coalesce(sum({c}){f}, 0)",
    # The sum of a large group may not fit a 64-bit integer.
    "sum of long": "coalesce(sum(CAST({c} AS DOUBLE)){f}, 0D)",
    "sum of floating": "CASE WHEN sum({c}){f} IS NULL THEN 0D WHEN NOT isnan(sum({c}){f}) THEN sum({c}){f} END",
    "var": "nanvl(var_samp({c}){f}, CAST(NULL AS DOUBLE))",
    "std": "nanvl(stddev_samp({c}){f}, CAST(NULL AS DOUBLE))",
    "skew": (
        "CASE WHEN count({c}){f} < 3 THEN NULL WHEN var_pop({c}){f} * count({c}){f} < " + _NO_SPREAD + " THEN 0D "
        "ELSE skewness({c}){f} * sqrt(count({c}){f} * (count({c}){f} - 1D)) / nullif(count({c}){f} - 2, 0) END"
    ),
    "count": "count({c}){f}",
    "size": "count(1){f}",
    "nunique": "count(DISTINCT {c}){f}",
    "all": "coalesce(bool_and({c} <> 0){f}, true)",
}
_ZERO_WHEN_EMPTY = {"sum", "count", "size", "nunique", "all"}


def agg_text(function: str, column: str, where: str | None = None, kind: str = "") -> str:
    """SQL text of one aggregate.

    Feature lists run to hundreds of columns; one parsed text per column is far
    cheaper to build than a tree of calls.  With ``where`` only matching rows
    count, and a group without any gives null, as it would after filtering,
    aggregating and left-joining back.  ``kind`` names the column's type where
    its sum differs: ``floating`` or ``long``.
    """
    f = "" if where is None else f" FILTER (WHERE {where})"
    template = _TEMPLATES[f"sum of {kind}" if function == "sum" and kind else function]
    text = template.format(c=quote(column), f=f)
    if where is not None and function in _ZERO_WHEN_EMPTY:
        text = f"CASE WHEN count_if({where}) > 0 THEN {text} END"
    return text


@dataclass(frozen=True)
class Subset:
    """Aggregates over the rows of a group that satisfy a condition."""

    prefix: str
    where: Column
    spec: Spec


@dataclass(frozen=True)
class Shares:
    """Aggregates of category indicators that are never built as columns.

    ``None`` in a value list stands for the missing category, named ``nan``.
    """

    values: Mapping[str, Sequence]
    functions: Sequence[str] = ("mean",)


def indicator_name(column: str, value) -> str:
    return f"{column}_{'nan' if value is None else value}"


def indicator(column: str, value) -> str:
    """The condition behind one category indicator, never null."""
    return f"{quote(column)} IS NULL" if value is None else f"{quote(column)} <=> {sql_literal(value)}"


# Everything about a 0/1 indicator follows from its count and the group's size,
# so all functions of one category share a single aggregate.
_SHARE_TEMPLATES = {
    "sum": "{hits}",
    "mean": "{hits} / count(1)",
    "max": "CAST({hits} > 0 AS INT)",
    "min": "CAST({hits} = count(1) AS INT)",
    "var": "({hits} - {hits} * {hits} / count(1)) / nullif(count(1) - 1, 0)",
}


def _share_text(function: str, condition: str) -> str:
    return _SHARE_TEMPLATES[function].format(hits=f"count_if({condition})")


def share_exprs(shares: Shares, prefix: str = "") -> dict[str, Column]:
    return {
        f"{prefix}{indicator_name(column, value)}_{function.upper()}": F.expr(
            _share_text(function, indicator(column, value))
        )
        for column, values in shares.values.items()
        for value in values
        for function in shares.functions
    }


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    spec: Spec,
    prefix: str = "",
    shares: Shares | None = None,
    subsets: Sequence[Subset] = (),
    extra: Mapping[str, Column] | None = None,
    deal: bool = False,
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    apart: bool = False,
) -> DataFrame:
    """Aggregate to one row per key in a single pass over ``df``.

    Output names are ``<prefix><column>_<FUNCTION>``.  Rows with a null key are
    left out.  NaN is null, and booleans are 0 and 1.  Subset and share aggregates ride in the same hash aggregation,
    so adding them costs no further scan, shuffle or join.  Medians need value
    order and are computed beside it, then joined on the key.

    ``deal`` first moves the rows to the tasks of their keys (see ``lookup.dealt``): for many
    aggregates and few rows per key, where combining before the shuffle would hold and move
    buffers that are wider than the rows.  Keys above ``hot_rows`` are found first, in
    ``counted`` where that is cheaper to read and has no fewer rows per key; ``apart`` is
    that of ``lookup.dealt``.
    """
    keys = list(keys)
    kept = df
    for key in keys:
        kept = kept.where(F.col(key).isNotNull())
    flags = [f"__subset{i}" for i in range(len(subsets))]
    if subsets:
        kept = kept.withColumns(
            {name: F.coalesce(s.where, F.lit(False)) for name, s in zip(flags, subsets, strict=True)}
        )

    used = {c for s in (spec, *(x.spec for x in subsets)) for c in s} - set(keys)
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    kinds = {c: {"float": "floating", "double": "floating", "long": "long"}.get(types.get(c, ""), "") for c in used | set(keys)}
    plain = {c: nan_to_null(c) for c in used if kinds[c] == "floating"} | {c: col(c).cast("int") for c in used if types.get(c) == "boolean"}
    if plain:
        kept = kept.withColumns(plain)
    rows, hot = kept, None
    if deal:
        counted = kept if counted is None else counted
        for key in keys:
            counted = counted.where(F.col(key).isNotNull())
        hot = hot_salts(counted, keys, hot_rows)
        kept = dealt(rows, keys, hot, apart)
    exprs: dict[str, Column] = {}
    medians: list[tuple[str, str, str | None]] = []

    def add(prefix: str, spec: Spec, where: str | None) -> None:
        for column, functions in spec.items():
            for function in functions:
                name = f"{prefix}{column}_{function.upper()}"
                if function == "median":
                    medians.append((name, column, where))
                else:
                    exprs[name] = F.expr(agg_text(function, column, where, kinds.get(column, "")))

    add(prefix, spec, None)
    if shares is not None:
        exprs |= share_exprs(shares, prefix)
    for flag_name, subset in zip(flags, subsets, strict=True):
        add(subset.prefix, subset.spec, flag_name)
    exprs |= dict(extra or {})

    if exprs:
        out = kept.groupBy(*keys).agg(*exprs.values()).toDF(*keys, *exprs)
    else:
        out = kept.select(*keys).distinct()
    if not medians:
        return out
    if hot is None:
        return out.join(_medians(rows, keys, medians), keys, "left")
    return out.join(_medians_of_dealt(rows, keys, medians, hot), keys, "left")


def _medians_of_dealt(
    rows: DataFrame, keys: list[str], wanted: Sequence[tuple[str, str, str | None]], hot: Mapping[int, int]
) -> DataFrame:
    """Medians of a key within the task of its rows; those of ``hot`` keys go by order over many tasks."""
    key = F.xxhash64(*[col(k) for k in keys])
    medians = [
        F.expr(f"percentile(CAST({quote(column)} AS DOUBLE), 0.5D)" + (f" FILTER (WHERE {where})" if where else "")).alias(name)
        for name, column, where in wanted
    ]
    few = rows.where(~key.isin(list(hot))) if hot else rows
    found = dealt(few, keys, {}).groupBy(*keys).agg(*medians)
    if not hot:
        return found
    return found.unionByName(_medians(rows.where(key.isin(list(hot))), keys, wanted))


def _medians(rows: DataFrame, keys: list[str], wanted: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """All requested medians in one ordered pass over (name, key, value) rows."""
    values = [
        f"named_struct('name', {sql_literal(name)}, 'value', "
        + (f"CAST({quote(column)} AS DOUBLE))" if where is None else f"CAST(CASE WHEN {where} THEN {quote(column)} END AS DOUBLE))")
        for name, column, where in wanted
    ]
    long = rows.selectExpr(*[quote(k) for k in keys], f"inline(array({', '.join(values)}))")
    found = group_quantiles(long, "value", {"median": 0.5}, ["name", *keys])
    picks = [F.max(F.when(F.col("name") == name, F.col("median"))).alias(name) for name, _, _ in wanted]
    return found.groupBy(*keys).agg(*picks)


def every_column(df: DataFrame, keys: Sequence[str], functions: Sequence[str]) -> dict[str, list[str]]:
    """A spec with the same functions for all numeric and boolean non-key columns."""
    numeric = {*columns_by_type(df, "numeric"), *columns_by_type(df, "boolean")} - set(keys)
    return {c: list(functions) for c in df.columns if c in numeric}


def count_nonzero(c: str) -> Column:
    """Rows whose value is not 0; a missing value is not 0 either."""
    return F.count_if(~col(c).eqNullSafe(F.lit(0)))


def percent_below(value: str, reference: str) -> Column:
    """Percent of the group's rows with ``value < reference``."""
    return F.lit(100.0) * F.count_if(col(value) < col(reference)) / F.count(F.lit(1))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key by a total order.

    The row-number filter lets Spark keep one row per key in every input task
    before the shuffle, so a key with very many rows costs no more than others.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__nth", F.row_number().over(first)).where(F.col("__nth") == 1).drop("__nth")


def argmax_row(df: DataFrame, keys: Sequence[str], value: str, tie_break: Sequence[Column | str]) -> DataFrame:
    """The row holding the group's largest value, the first by ``tie_break`` on ties."""
    return first_per_key(df, keys, [col(value).desc_nulls_last(), *tie_break])
