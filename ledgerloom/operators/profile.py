"""Column profiles and column selection."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import col, quote
from .project import columns_by_type
from .ranking import column_quantiles


def null_shares(df: DataFrame) -> DataFrame:
    """Share of nulls per column, as one row."""
    shares = df.selectExpr(*[f"count_if({quote(c)} IS NULL) / nullif(count(1), 0)" for c in df.columns])
    return shares.toDF(*df.columns)


def value_frequencies(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out))


def quasi_constant_columns(df: DataFrame, threshold: float = 0.98) -> list[str]:
    """Columns where one non-null value fills at least ``threshold`` of all rows.

    A frequent-items sketch names the candidates: it cannot miss a value held by
    more than a small share of the rows.  A second pass counts the candidates
    exactly.  Neither pass shuffles values.  Thresholds too low for the sketch
    are counted in full.
    """
    if threshold < 0.01:
        longest = _largest_counts(df)
        return [c for c in df.columns if longest[c] >= threshold * longest[None]]
    # With this many counters the sketch errs by less than a fifth of the
    # threshold, so k candidates cover every value that reaches it.
    tracked = max(64, math.ceil(20 / threshold))
    k = math.ceil(1.25 / threshold) + 1
    tops = df.selectExpr(*[f"approx_top_k({quote(c)}, {k}, {tracked})" for c in df.columns]).first()
    counts = []
    candidates = []
    for i, c in enumerate(df.columns):
        for j, item in enumerate(tops[i] or []):
            if item["item"] is not None:
                candidates.append(c)
                hit = col(c) == F.lit(item["item"]).cast(df.schema[c].dataType)
                counts.append(F.count_if(hit).alias(f"c{i}_{j}"))
    exact = df.agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    frequent = {c for c, n in zip(candidates, exact[1:], strict=True) if n >= threshold * exact["rows"]}
    return [c for c in df.columns if c in frequent]


def _largest_counts(df: DataFrame) -> dict:
    rows = df.count()
    out = {None: rows}
    text = df.select(*[col(c).cast("string").alias(c) for c in df.columns])
    long = text.unpivot([], df.columns, "column", "value").where(F.col("value").isNotNull())
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    found = {r["column"]: r["n"] for r in counted.groupBy("column").agg(F.max("n").alias("n")).collect()}
    return out | {c: found.get(c, 0) for c in df.columns}


def duplicate_columns(df: DataFrame, row_key: Sequence[str]) -> list[str]:
    """Later columns equal in every row, null for null, to an earlier one of the same type.

    Each column is reduced to one checksum over (row key, value); only columns
    with equal checksums are compared, so the work is linear in the columns.
    """
    columns = [c for c in df.columns if c not in row_key]
    sums = df.agg(
        *[
            F.bit_xor(F.xxhash64(*[col(k) for k in row_key], col(c))).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    groups: dict[tuple, list[str]] = {}
    for c, checksum in zip(columns, sums, strict=True):
        groups.setdefault((df.schema[c].dataType.typeName(), checksum), []).append(c)

    duplicates: set[str] = set()
    pending = [g for g in groups.values() if len(g) > 1]
    while pending:
        pairs = [(g[0], c) for g in pending for c in g[1:]]
        differ = df.agg(
            *[
                F.count_if(~col(a).eqNullSafe(col(b))).alias(f"p{i}")
                for i, (a, b) in enumerate(pairs)
            ]
        ).first()
        unequal = {b for (_, b), n in zip(pairs, differ, strict=True) if n > 0}
        duplicates |= {b for _, b in pairs if b not in unequal}
        rest = [[c for c in g[1:] if c in unequal] for g in pending]
        pending = [g for g in rest if len(g) > 1]
    return [c for c in columns if c in duplicates]


#: Columns to a tile of the moment matrices, and bytes of matrices that a task holds.
TILE = 64
HELD = 256 << 20
_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _tile_moments(df: DataFrame, centre: np.ndarray) -> DataFrame:
    """``i, j`` (i above j) and the moments of each pair of the columns of ``df``.

    A task gives out one packed row per pair of column tiles; packed rows are added up
    by shuffle, and only their sums become a row per pair of columns.
    """
    width = len(centre)
    tiles = [slice(t, min(t + TILE, width)) for t in range(0, width, TILE)]
    pairs = [(a, b) for a in range(len(tiles)) for b in range(a + 1)]
    hold = len(pairs) * len(_MOMENTS) * TILE * TILE * 8 <= HELD

    def packed(total: dict) -> pa.RecordBatch:
        a, b = zip(*total)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], names=["a", "b", "sums"]
        )

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - centre
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            known = known.astype(np.float64)
            square = x * x
            for a, b in pairs:
                i, j = tiles[a], tiles[b]
                left, right = (known[:, i], x[:, i], square[:, i]), (known[:, j], x[:, j], square[:, j])
                part = np.stack([left[p].T @ right[q] for p, q in ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1))])
                total[a, b] = total[a, b] + part if (a, b) in total else part
                if not hold:
                    yield packed(total)
                    total.clear()
        if total:
            yield packed(total)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def rows() -> pa.RecordBatch:
            i, j = tiles[key[0]], tiles[key[1]]
            sums = total.reshape(len(_MOMENTS), i.stop - i.start, j.stop - j.start)
            at = np.nonzero(np.arange(i.start, i.stop)[:, None] > np.arange(j.start, j.stop))
            columns = [pa.array((x + s.start).astype(np.int32)) for x, s in zip(at, (i, j))]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array(s[at]) for s in sums]], names=["i", "j", *_MOMENTS])

        for batch in batches:
            for a, b, blob in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(blob)
                if (a, b) != key and key is not None:
                    yield rows()
                total = total + part if (a, b) == key else part
                key = (a, b)
        if key is not None:
            yield rows()

    parts = df.mapInArrow(moments, "a int, b int, sums binary").repartition("a", "b").sortWithinPartitions("a", "b")
    return parts.mapInArrow(unpacked, "i int, j int, " + ", ".join(f"{m} double" for m in _MOMENTS))


def column_correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each column pair over the rows where both are known.

    The pairs are pairs of columns, so their number does not grow with the data.

    Every task turns its rows into the moment matrices of all pairs, one matrix
    product per Arrow batch and pair of column tiles, and the matrices are added up tile
    by tile; one scan serves any number of columns.  Columns are centred on their means
    first to keep the sums accurate.  Returns ``column_a, column_b, corr`` with ``a``
    before ``b`` in column order; ``corr`` is null where either side does not vary.
    """
    columns = columns_by_type(df, "numeric") if columns is None else list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    numbers = df.selectExpr(*[f"CAST({quote(c)} AS DOUBLE) AS c{i}" for i, c in enumerate(columns)])
    means = numbers.selectExpr(*[f"avg(nanvl({c}, CAST(NULL AS DOUBLE)))" for c in numbers.columns]).first()
    centre = np.array([0.0 if m is None else m for m in means])
    summed = _tile_moments(numbers, centre)
    n = F.col("n")
    var_x = F.col("sxx") - F.try_divide(F.col("sx") * F.col("sx"), n)
    var_y = F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), n)
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    # A variance this far below its raw moment is rounding noise of a constant.
    flat_x = var_x <= F.col("sxx") * F.lit(1e-12)
    flat_y = var_y <= F.col("syy") * F.lit(1e-12)
    names = F.array(*[F.lit(c) for c in columns])
    return summed.select(
        F.get(names, F.col("j")).alias("column_a"),
        F.get(names, F.col("i")).alias("column_b"),
        F.when(~flat_x & ~flat_y, F.try_divide(cov, F.sqrt(var_x * var_y))).alias("corr"),
    )


def correlated_columns(df: DataFrame, threshold: float, columns: Sequence[str] | None = None) -> list[str]:
    """Columns correlated above ``threshold`` in size with any column before them."""
    columns = columns_by_type(df, "numeric") if columns is None else list(columns)
    pairs = column_correlations(df, columns).where(F.abs("corr") > F.lit(threshold))
    found = {r["column_b"] for r in pairs.select("column_b").distinct().collect()}
    return [c for c in columns if c in found]


def low_variance_columns(df: DataFrame, limit: float = 0.1, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns with a sample standard deviation under ``limit``."""
    columns = columns_by_type(df, "numeric") if columns is None else list(columns)
    if not columns:
        return []
    spread = df.selectExpr(*[f"stddev_samp({quote(c)})" for c in columns]).first()
    return [c for c, s in zip(columns, spread, strict=True) if s is not None and s < limit]


def outlier_caps(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Upper cap per column: the 99th percentile plus 1.5 times its span to the 1st."""
    found = column_quantiles(df, columns, {"low": 0.01, "high": 0.99}).collect()
    return {r["column"]: r["high"] + 1.5 * (r["high"] - r["low"]) for r in found}


def cap_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pull values above the cap down to it; nulls stay null."""
    caps = outlier_caps(df, columns)
    return df.withColumns(
        {c: F.when(col(c) > F.lit(cap), F.lit(cap)).otherwise(col(c)) for c, cap in caps.items()}
    )


# Open bounds of each type a column may be narrowed to (fixed values).
_INTEGER_BOUNDS = {
    "byte": (-128, 127),
    "short": (-32768, 32767),
    "int": (-2147483648, 2147483647),
}
_FLOAT_BOUND = 3.4028234663852886e38


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast numeric columns to the smallest type whose bounds lie strictly outside the data; decimals stay exact."""
    columns = [c for c in columns_by_type(df, "numeric") if df.schema[c].dataType.typeName() != "decimal"]
    spans = df.selectExpr(
        *[f"{f}({quote(c)}) AS {f}{i}" for i, c in enumerate(columns) for f in ("min", "max")]
    ).first()
    targets = {}
    floating = set(columns_by_type(df, "floating"))
    for i, c in enumerate(columns):
        lo, hi = spans[f"min{i}"], spans[f"max{i}"]
        if lo is None:
            continue
        if c in floating:
            if -_FLOAT_BOUND < lo and hi < _FLOAT_BOUND:
                targets[c] = "float"
        else:
            fitting = [t for t, (a, b) in _INTEGER_BOUNDS.items() if a < lo and hi < b]
            targets[c] = fitting[0] if fitting else "bigint"
    casts = [f"CAST({quote(c)} AS {targets[c]})" if c in targets else quote(c) for c in df.columns]
    return df.selectExpr(*casts).toDF(*df.columns)
