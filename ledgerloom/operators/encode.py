"""Categorical encoders.

Category lists are learned once per table, in one pass over all its text
columns.  Only dense one-hot encoding brings all values of a column to the
driver, under a limit; the others bring at most a few values per column, or none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import col, quote
from ..sources import checkpoint
from .aggregate import indicator, indicator_name
from .lookup import HOT_ROWS, lookup_join
from .ranking import positions

# Dense one-hot encoding makes a column per value; the default limit per source column.
MAX_INDICATORS = 20_000
# Codes for fewer values than this travel inside the expression.
MAX_INLINE_CODES = 200


#: Values per column that are known beforehand; None: learn them from the data.
Known = Mapping[str, Sequence] | None


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, nulls included: ``column, value, n``."""
    long = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def learn_counts(df: DataFrame, columns: Sequence[str], limit: int = MAX_INDICATORS) -> dict[str, dict]:
    """``{column: {value: rows}}`` on the driver.

    For work that needs all values there, such as a column per value: a column
    of more than ``limit`` values is an error that names it.  The other encoders
    do not come this way.
    """
    columns = list(columns)
    if not columns:
        return {}
    counts = category_counts(df, columns)
    within = Window.partitionBy("column").orderBy("value")
    # Spark keeps the first limit + 1 rows of each column in every task before it shuffles.
    first = counts.withColumn("__nth", F.row_number().over(within)).where(F.col("__nth") <= limit + 1)
    out: dict[str, dict] = {c: {} for c in columns}
    for row in first.collect():
        out[row["column"]][row["value"]] = row["n"]
    many = [c for c, values in out.items() if len(values) > limit]
    if many:
        raise ValueError(f"more than {limit} distinct values in {', '.join(many)}; raise the limit or use the long form")
    return out


def learn_values(
    df: DataFrame, columns: Sequence[str], order: Column | None = None, limit: int = MAX_INDICATORS
) -> dict[str, list]:
    """Values of each column in code order, nulls last: one pass for all encoders of a table.

    Code order is that of the value or, with ``order`` (unique per row), of first
    appearance.  A column of more than ``limit`` values is left out; encoders
    that take such columns learn them by a distributed sort.  An order of a
    number type keeps to a hash aggregation, whose memory is that of the values;
    the least text or struct of a value would sort all rows in every input task.
    """
    columns = list(columns)
    if not columns:
        return {}
    text = df.select(*([] if order is None else [order.alias("__order")]), *[col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([] if order is None else ["__order"], columns, "column", "value")
    if order is None:
        values = long.distinct().withColumn("first", F.col("value"))
    else:
        values = long.groupBy("column", "value").agg(F.min("__order").alias("first"))
    nth = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    out: dict[str, list] = {c: [] for c in columns}
    for row in values.withColumn("__nth", nth).where(F.col("__nth") <= limit + 1).collect():
        out[row["column"]].append(row)
    return {
        c: [r["value"] for r in sorted(rows, key=lambda r: (r["value"] is None, r["value"] is not None and r["first"]))]
        for c, rows in out.items()
        if len(rows) <= limit
    }


def learn_categories(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    null_column: bool = True,
    drop_first: bool = False,
    limit: int = MAX_INDICATORS,
) -> dict[str, list]:
    """Sorted values of each text column, followed by ``None`` for the null column.

    The null category is listed whether or not a null was seen.  ``limit``
    bounds the values of one column.
    """
    columns = text_columns(df) if columns is None else list(columns)
    out = {}
    for column, counts in learn_counts(df, columns, limit).items():
        values = sorted(v for v in counts if v is not None)
        if drop_first:
            values = values[1:]
        out[column] = values + ([None] if null_column else [])
    return out


def category_lists(
    df: DataFrame,
    known: Mapping[str, Sequence] | None,
    columns: Sequence[str] | None = None,
    null_column: bool = True,
    drop_first: bool = False,
) -> dict[str, list]:
    """Category lists from ``known`` values per column, or learned where that is None.

    Known values need no pass over the data, and fix the columns of the result
    whatever the data hold.  A column without known values is an error.
    """
    if known is None:
        return learn_categories(df, columns, null_column, drop_first)
    columns = text_columns(df) if columns is None else list(columns)
    if missing := [c for c in columns if c not in known]:
        raise ValueError(f"no known categories for {', '.join(missing)}: none given, or too many to make a column of each")
    lists = {c: sorted(v for v in known[c] if v is not None)[int(drop_first) :] for c in columns}
    return {c: values + ([None] if null_column else []) for c, values in lists.items()}


def category_share_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Category shares in long form: keys, ``column, value, n, share``, for any number of values.

    A null is a value; shares are of the key's rows.  Rows with a null key are left out.
    """
    keys = list(keys)
    kept = df
    for key in keys:
        kept = kept.where(col(key).isNotNull())
    long = kept.select(*[col(k) for k in keys], *[col(c).cast("string").alias(c) for c in columns]).unpivot(
        keys, list(columns), "column", "value"
    )
    counts = long.groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.join(sizes, keys).select(*keys, "column", "value", "n", (F.col("n") / F.col("__rows")).alias("share"))


def one_hot_sparse(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One-hot encoding for any number of values: rows ``key, index`` of ones, and ``column, value, index``.

    Indices run over all columns in order of (column, value); a null is a value.
    """
    counts = category_counts(df, columns).select("column", F.coalesce("value", F.lit("")).alias("__v"), F.col("value").isNull().alias("__null"), "n")
    counts = counts.withColumn("__one", F.lit(1).cast("bigint"))
    placed = positions(counts, ["column", "__null", "__v"], weights=["__one"]).withColumnRenamed("__before__one", "index")
    long = df.select(*[col(k) for k in key], *[col(c).cast("string").alias(c) for c in columns]).unpivot(list(key), list(columns), "column", "value")
    long = long.select(*key, "column", F.coalesce("value", F.lit("")).alias("__v"), F.col("value").isNull().alias("__null"))
    ones = lookup_join(long, placed.select("column", "__v", "__null", "n", "index"), ["column", "__v", "__null"], "n")
    values = placed.select("column", F.when(~F.col("__null"), F.col("__v")).alias("value"), "index")
    return ones.select(*key, "index"), values


def one_hot(df: DataFrame, categories: Mapping[str, Sequence]) -> tuple[DataFrame, list[str]]:
    """Replace columns by 0/1 indicators; returns the frame and the new names."""
    new = {indicator_name(c, v): indicator(c, v) for c, values in categories.items() for v in values}
    kept = [c for c in df.columns if c not in categories]
    encoded = df.selectExpr(*[quote(c) for c in kept], *[f"CAST({condition} AS INT)" for condition in new.values()])
    return encoded.toDF(*kept, *new), list(new)


def one_hot_encoder(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    null_column: bool = True,
    drop_first: bool = False,
    limit: int = MAX_INDICATORS,
) -> tuple[DataFrame, list[str]]:
    """Learn the categories of the text columns and encode them."""
    return one_hot(df, learn_categories(df, columns, null_column, drop_first, limit))


@dataclass(frozen=True)
class Codes:
    """Integer codes of one column.

    Few codes are kept as a map inside the expression; many stay a table and
    are joined, with values that hold very many rows kept out of the shuffle.
    """

    column: str
    missing: int | None
    inline: dict | None = None
    table: DataFrame | None = None

    def apply(self, df: DataFrame, out: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
        out = out or self.column
        if self.inline is not None:
            return df.withColumn(out, self.expr())
        coded = lookup_join(df, self.table.withColumnRenamed("code", "__code"), [self.column], "n", hot_rows)
        code = F.coalesce("__code", F.lit(self.missing).cast("int"))
        return coded.withColumn(out, code).drop("__code")

    def expr(self) -> Column:
        missing = F.lit(self.missing).cast("int")
        if not self.inline:
            return missing
        pairs = [F.lit(x) for value, code in self.inline.items() for x in (value, code)]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), col(self.column)), missing)


def _first_values(rows: DataFrame, by: Sequence[str], value: str, order: Column | str | None) -> DataFrame:
    """Rows per value and its place: the least ``order``, or the value itself, which needs no aggregate (a least text sorts)."""
    counted = rows.groupBy(*by)
    if order is None:
        return counted.agg(F.count(F.lit(1)).alias("n")).withColumn("first", col(value))
    return counted.agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))


def _codes(df: DataFrame, column: str, order: Column | str | None, missing: int | None, inline_limit: int) -> Codes:
    values = _first_values(df.where(col(column).isNotNull()), [column], column, order)
    few = values.limit(inline_limit + 1).collect()
    if len(few) <= inline_limit:
        ordered = sorted(few, key=lambda r: r["first"])
        return Codes(column, missing, inline={r[column]: i for i, r in enumerate(ordered)})
    placed = positions(values.withColumn("__one", F.lit(1).cast("bigint")), ["first"], weights=["__one"])
    table = placed.select(column, "n", F.col("__before__one").cast("int").alias("code"))
    return Codes(column, missing, table=table)


def label_codes(df: DataFrame, column: str, inline_limit: int = MAX_INLINE_CODES) -> Codes:
    """Codes in ascending order of the value; a null has no code."""
    return _codes(df, column, None, None, inline_limit)


def first_seen_codes(df: DataFrame, column: str, order: str, inline_limit: int = MAX_INLINE_CODES) -> Codes:
    """Codes in order of first appearance by ``order`` (unique per row); null is -1."""
    return _codes(df, column, order, -1, inline_limit)


def _encode_many(df: DataFrame, columns: Sequence[str], order: Column | None, missing: int | None) -> DataFrame:
    columns = list(columns)
    if not columns:
        return df
    text = [col(c).cast("string").alias(c) for c in columns]
    ids = [] if order is None else ["__order"]
    rows = df.select(*text) if order is None else df.select(order.alias("__order"), *text)
    long = rows.unpivot(ids, columns, "column", "value").where(F.col("value").isNotNull())
    learned = checkpoint(_first_values(long, ["column", "value"], "value", None if order is None else "__order"))
    sizes = {r["column"]: r["values"] for r in learned.groupBy("column").agg(F.count(F.lit(1)).alias("values")).collect()}
    inline = [c for c in columns if sizes.get(c, 0) <= MAX_INLINE_CODES]
    values: dict[str, list] = {c: [] for c in inline}
    if inline:
        few = learned.where(F.col("column").isin(inline)).collect()  # at most MAX_INLINE_CODES rows per column
        for row in sorted(few, key=lambda r: r["first"]):
            values[row["column"]].append(row["value"])
    for c in columns:
        if c not in values:  # a code table, placed by a distributed sort and joined
            own = learned.where(F.col("column") == c).select(F.col("value").alias(c), "n", "first", F.lit(1).cast("bigint").alias("__one"))
            placed = positions(own, ["first"], weights=["__one"])
            table = placed.select(col(c), "n", F.col("__before__one").cast("int").alias("code"))
            df = Codes(c, missing, table=table).apply(df)
    coded = {c: Codes(c, missing, inline={v: i for i, v in enumerate(vs)}).expr() for c, vs in values.items()}
    return df.withColumns(coded) if coded else df


def _known_codes(df: DataFrame, columns: Sequence[str], known: Known, missing: int | None, sort: bool) -> tuple[DataFrame, list[str]]:
    """Code the columns whose values are known and few; returns those left to learn."""
    exprs, rest = {}, []
    for c in columns:
        values = None if known is None or c not in known else [v for v in known[c] if v is not None]
        if values is None or len(values) > MAX_INLINE_CODES:
            rest.append(c)
        else:
            exprs[c] = Codes(c, missing, inline={v: i for i, v in enumerate(sorted(values) if sort else values)}).expr()
    return df.withColumns(exprs) if exprs else df, rest


def label_encode(df: DataFrame, columns: Sequence[str], known: Known = None) -> DataFrame:
    """Alphabetical integer codes for text columns.

    One pass learns them all; columns with too many values to hold on the
    driver are coded by a distributed sort instead.  Columns in ``known`` are
    coded by the values given there, without a pass.
    """
    df, rest = _known_codes(df, columns, known, None, sort=True)
    return _encode_many(df, rest, None, None)


def first_seen_encode(df: DataFrame, columns: Sequence[str], order: Column, known: Known = None) -> DataFrame:
    """Codes by first appearance under a total row order; null is -1.  One pass for all columns.

    Columns in ``known`` are coded by the place of their values there.
    """
    df, rest = _known_codes(df, columns, known, -1, sort=False)
    return _encode_many(df, rest, order, -1)


def label_encode_binary(df: DataFrame, known: Known = None) -> tuple[DataFrame, list[str]]:
    """Alphabetical codes for text columns with at most two distinct values.

    A null counts as a value; where one is among the two it is coded last.
    With ``known`` values the columns are chosen and coded by these, without a pass.
    """
    columns = text_columns(df)
    if not columns:
        return df, []
    if known is not None:
        exprs = {}
        for c in columns:
            if c in known and len(set(known[c])) <= 2:
                values = sorted({v for v in known[c] if v is not None})
                missing = len(values) if None in known[c] else None
                exprs[c] = Codes(c, missing, inline={v: n for n, v in enumerate(values)}).expr()
        return df.withColumns(exprs) if exprs else df, list(exprs)
    ends = df.agg(
        *[f(col(c)).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (("lo", F.min), ("hi", F.max))],
        *[F.count_if(col(c).isNull()).alias(f"null{i}") for i, c in enumerate(columns)],
    ).first()
    # At most two values: every value is the smallest or the largest.
    between = [F.count_if((col(c) != ends[f"lo{i}"]) & (col(c) != ends[f"hi{i}"])).alias(f"more{i}") for i, c in enumerate(columns) if ends[f"lo{i}"] is not None]
    more = df.agg(*between).first().asDict() if between else {}
    exprs = {}
    for i, c in enumerate(columns):
        values = sorted({v for v in (ends[f"lo{i}"], ends[f"hi{i}"]) if v is not None})
        missing = len(values) if ends[f"null{i}"] else None
        if not more.get(f"more{i}", 0) and len(values) + (missing is not None) <= 2:
            exprs[c] = Codes(c, missing, inline={v: n for n, v in enumerate(values)}).expr()
    return df.withColumns(exprs) if exprs else df, list(exprs)


def _frequent(df: DataFrame, columns: Sequence[str], keep) -> tuple[dict[str, list], dict[str, int]]:
    """Values of each column that ``keep(column, share)`` holds for, and the number of its values.

    Shares add up to one, so a lower bound on the share bounds what reaches the driver.
    """
    counts = checkpoint(category_counts(df, columns))
    size = counts.groupBy("column").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values")).collect()
    rows, values = {r["column"]: r["rows"] for r in size}, {r["column"]: r["values"] for r in size}
    hit = F.lit(False)
    for c in columns:
        if rows.get(c):
            hit = hit | ((F.col("column") == c) & keep(c, F.col("n"), F.lit(rows[c])))
    kept: dict[str, list] = {c: [] for c in columns}
    for r in counts.where(hit).collect():
        kept[r["column"]].append(r["value"])
    return kept, values


def rare_labels(
    df: DataFrame,
    columns: Sequence[str],
    min_share: float = 0.05,
    min_categories: int = 4,
    label: str = "Rare",
    known: Known = None,
) -> DataFrame:
    """Merge values seen in less than ``min_share`` of all rows.

    Columns with at most ``min_categories`` values are left alone, and so are nulls.
    ``known`` holds the values after merging and saves the pass: a column that has
    ``label`` there keeps its other known values, one without it is left alone.
    """
    if known is not None:
        merged = {c: [v for v in known[c] if v is not None] for c in columns if label in known.get(c, ())}
        kept_known = {c: F.when(col(c).isNull() | col(c).isin(vs), col(c)).otherwise(F.lit(label)) for c, vs in merged.items()}
        return df.withColumns(kept_known) if kept_known else df
    kept, values = _frequent(df, columns, lambda c, n, rows: n / rows >= min_share)
    exprs = {}
    for c in columns:
        if values.get(c, 0) > min_categories:
            known = [v for v in kept[c] if v is not None]
            exprs[c] = F.when(col(c).isNull() | col(c).isin(known), col(c)).otherwise(F.lit(label))
    return df.withColumns(exprs) if exprs else df


def rare_labels_percent(df: DataFrame, thresholds: Mapping[str, float], label: str = "Rare") -> DataFrame:
    """Merge values whose percent of all rows is at most a per-column threshold.

    A null is a value like any other.
    """
    # No value has zero percent: such a threshold merges nothing.
    columns = [c for c, percent in thresholds.items() if percent > 0]
    if not columns:
        return df
    kept, _ = _frequent(df, columns, lambda c, n, rows: n * 100 / rows > thresholds[c])
    exprs = {}
    for c in columns:
        known = col(c).isin([v for v in kept[c] if v is not None])
        common = F.coalesce(known, F.lit(None in kept[c]))
        exprs[c] = F.when(common, col(c)).otherwise(F.lit(label))
    return df.withColumns(exprs)
