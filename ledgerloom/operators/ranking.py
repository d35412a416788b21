"""Global order statistics without sending a whole group to one task.

``positions`` range-partitions rows by group and value, so that a large group
spans many tasks, numbers the rows inside each range and shifts every range by
the size of the ranges before it.  Exact quantiles, averaged ranks, ROC AUC and
balanced folds are all read off those positions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_div
from ..functions.arithmetic import col
from ..sources import checkpoint
from .lookup import HOT_ROWS, lookup_join

BEFORE = "__before"
TOTAL = "__total"
_RANGE = "__range"
_SIZE = "__size"
_LOCAL = "__local"
_N = "__n"


def positions(
    df: DataFrame,
    order: Sequence[str],
    group_by: Sequence[str] = (),
    weights: Sequence[str] = (_N,),
) -> DataFrame:
    """Add, per weight column, the weight before the row and the group's total.

    The new columns are ``__before_<weight>`` and ``__total_<weight>``.
    ``order`` must be unique within a group: pre-aggregate ties first, which
    also keeps a value shared by very many rows from filling one range.
    The range of a row is fixed by a checkpoint, so a lost executor cannot
    move rows between ranges after their sizes have been added up.
    """
    group_by, order, weights = list(group_by), list(order), list(weights)
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpoint(
        df.repartitionByRange(ranges, *group_by, *order).withColumn(_RANGE, F.spark_partition_id())
    )

    inside = Window.partitionBy(*group_by, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns(
        {_LOCAL + w: F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in weights}
    )
    sizes = ranged.groupBy(*group_by, _RANGE).agg(*[F.sum(w).alias(_SIZE + w) for w in weights])

    if group_by:
        earlier = Window.partitionBy(*group_by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        everything = Window.partitionBy(*group_by)
        shifts = sizes.select(
            *group_by,
            _RANGE,
            *[F.coalesce(F.sum(_SIZE + w).over(earlier), F.lit(0)).alias(BEFORE + w) for w in weights],
            *[F.sum(_SIZE + w).over(everything).alias(TOTAL + w) for w in weights],
        )
        local = local.join(shifts, [*group_by, _RANGE])
        shift = {w: F.col(BEFORE + w) for w in weights}
        total = {w: F.col(TOTAL + w) for w in weights}
    else:
        # One row per range, whatever the size of the input.
        by_range = {r[_RANGE]: r for r in sizes.collect()}
        shift, total = {}, {}
        for w in weights:
            running, starts = 0, []
            for i in range(ranges):
                starts.append(running)
                running += by_range[i][_SIZE + w] if i in by_range else 0
            shift[w] = F.get(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col(_RANGE))
            total[w] = F.lit(running).cast("bigint")

    return local.select(
        *df.columns,
        *[(F.col(_LOCAL + w) + shift[w]).alias(BEFORE + w) for w in weights],
        *[total[w].alias(TOTAL + w) for w in weights],
    )


def value_counts(df: DataFrame, value: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Rows per non-null value (and group): the tie-free input of ``positions``."""
    kept = df.where(F.col(value).isNotNull())
    for key in group_by:
        kept = kept.where(F.col(key).isNotNull())
    return kept.groupBy(*group_by, value).agg(F.count(F.lit(1)).alias(_N))


def group_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group."""
    placed = positions(value_counts(df, value, group_by), [value], group_by)
    before, total = F.col(BEFORE + _N), F.col(TOTAL + _N)

    def at(place: Column) -> Column:
        return F.max(F.when((before <= place) & (place < before + F.col(_N)), F.col(value).cast("double")))

    picks = []
    for name, q in quantiles.items():
        place = (total - 1) * F.lit(float(q))
        picks += [
            at(F.floor(place)).alias(f"{name}__low"),
            at(F.ceil(place)).alias(f"{name}__high"),
            F.max(place - F.floor(place)).alias(f"{name}__part"),
        ]
    found = placed.groupBy(*group_by).agg(*picks)
    return found.select(
        *group_by,
        *[
            (
                F.col(f"{name}__low")
                + (F.col(f"{name}__high") - F.col(f"{name}__low")) * F.col(f"{name}__part")
            ).alias(name)
            for name in quantiles
        ],
    )


def column_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float]) -> DataFrame:
    """Exact quantiles of several numeric columns: one row per column name."""
    doubles = df.select(*[col(c).cast("double").alias(c) for c in columns])
    long = doubles.unpivot([], list(columns), "column", "value")
    return group_quantiles(long, "value", quantiles, ["column"])


def average_rank(df: DataFrame, value: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Ascending rank over the whole table, ties sharing their mean rank; null for null."""
    placed = positions(value_counts(df, value), [value])
    rank = F.col(BEFORE + _N) + (F.col(_N) + 1) / F.lit(2.0)
    return lookup_join(df, placed.select(value, _N, rank.alias(out)), [value], _N, hot_rows)


def roc_auc(
    df: DataFrame,
    label: str,
    score: str,
    out: str = "auc",
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null for a single class.

    With ``group_by`` one row per group, for example per fold, in the same pass.
    """
    by_score = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*group_by, score)
        .agg(
            F.count_if(F.col(label) == 1).alias("__pos"),
            F.count_if(F.col(label) != 1).alias("__neg"),
        )
    )
    placed = positions(by_score, [score], group_by, weights=["__pos", "__neg"])
    wins = F.col("__pos") * (F.col(BEFORE + "__neg") + F.col("__neg") / F.lit(2.0))
    pairs = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return placed.groupBy(*group_by).agg(safe_div(F.sum(wins), pairs).alias(out))


def row_positions(df: DataFrame, order: Sequence[str], group_by: Sequence[str], out: str) -> DataFrame:
    """Zero-based position of each row within its group, by a total order."""
    placed = positions(df.withColumn(_N, F.lit(1).cast("bigint")), order, group_by)
    return placed.select(*df.columns, F.col(BEFORE + _N).alias(out))
