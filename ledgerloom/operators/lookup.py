"""Attach per-key values to rows when some keys hold very many rows.

An equi-join sends all rows of a key to one task.  Where the value table also
knows how many rows each key has, the rows of the largest keys are dealt over
several salts, and their values are replicated to each salt.  Null keys, which
match nothing, are dealt over salts as well.  The rows are read once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import col
from ..sources import checkpoint

#: Rows of a key that one task takes; keys with more are salted.
HOT_ROWS = 5_000_000
#: Keys that are salted at most, those with the most rows; their hashes travel inside the expression.
SALTED_KEYS = 1000
#: Most salts of a key, and salts of null keys.
SALTS = 10_000

_COUNT = "__key_rows"
_SALT = "__salt"


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    count: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join ``lookup`` (one row per key) to ``rows``.

    ``count`` is the column of ``lookup`` with the number of rows of its key.
    Rows with a null key match nothing.  The value table is settled first, as
    the largest keys are read from it before the join.  A row's salt is a hash
    of the row, so a repeated task deals it out alike.
    """
    on = list(on)
    values = [c for c in lookup.columns if c not in on and c != count]
    out = [*rows.columns, *values]
    lookup = checkpoint(lookup)
    key = F.xxhash64(*[col(k) for k in on])
    each = F.least(F.ceil(col(count) / max(hot_rows, 1)), F.lit(SALTS)).cast("int")
    largest = lookup.where(col(count) > hot_rows).orderBy(F.desc(count), *[col(k) for k in on]).limit(SALTED_KEYS)
    hot = {r["key"]: r["salts"] for r in largest.select(key.alias("key"), each.alias("salts")).collect()}
    pairs = [F.lit(x) for item in hot.items() for x in item]
    salts = F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(1)) if hot else F.lit(1)

    has_null = reduce(lambda a, b: a | b, [col(k).isNull() for k in on])
    spread = F.xxhash64(*[col(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()])
    salt = F.when(has_null, F.pmod(spread, F.lit(SALTS))).when(salts > 1, F.pmod(spread, salts)).otherwise(0).cast("int")
    replicated = lookup.select(*[col(k) for k in on], *[col(v) for v in values], F.explode(F.sequence(F.lit(0), salts - 1)).alias(_SALT))
    joined = rows.withColumn(_SALT, salt).join(replicated, [*on, _SALT], "left")
    return joined.select(*[col(c) for c in out])


def hot_salts(counted: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> dict[int, int]:
    """Key hash to salts of the keys with more than ``hot_rows`` rows in ``counted``, the largest ``SALTED_KEYS`` of them."""
    counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT))
    each = F.least(F.ceil(col(_COUNT) / max(hot_rows, 1)), F.lit(SALTS)).cast("int")
    largest = counts.where(col(_COUNT) > hot_rows).orderBy(F.desc(_COUNT), *[col(k) for k in keys]).limit(SALTED_KEYS)
    return {r["key"]: r["salts"] for r in largest.select(F.xxhash64(*[col(k) for k in keys]).alias("key"), each.alias("salts")).collect()}


def dealt(rows: DataFrame, keys: Sequence[str], hot: Mapping[int, int], apart: bool = False) -> DataFrame:
    """``rows`` with those of a key in one task, but the rows of ``hot`` keys (see ``hot_salts``) dealt over salts.

    For aggregates wider than the rows: after it no task holds buffers of keys that
    others hold too, and rows move instead of buffers.  Without hot keys aggregating by
    ``keys`` moves nothing more; otherwise it adds up what the tasks of a hot key have
    combined.  ``apart`` keeps every shuffle partition a task of its own: adaptive execution
    merges partitions by their compressed bytes, which say little of the memory of
    aggregates and joins that are much wider than the rows.
    """
    parts = [int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if apart else []
    if not hot:
        return rows.repartition(*parts, *[col(k) for k in keys])
    key = F.xxhash64(*[col(k) for k in keys])
    salts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for item in hot.items() for x in item]), key), F.lit(1))
    spread = F.xxhash64(*[col(f.name) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()])
    salt = F.when(salts > 1, F.pmod(spread, salts)).otherwise(0)
    return rows.repartition(*parts, *[col(k) for k in keys], salt)


def attach_group_stats(
    rows: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Write group aggregates back on each row of the group."""
    table = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT), *stats)
    return lookup_join(rows, table, keys, _COUNT, hot_rows)
