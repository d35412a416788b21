"""Fold assignment without a global shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import key_digest
from ..operators.ranking import row_positions

# Folds and seed of the published training runs (fixed values).
FOLDS = 10
SEED = 1001


def assign_folds(df: DataFrame, key: Sequence[str], k: int = FOLDS, seed: int = SEED, out: str = "fold") -> DataFrame:
    """Fold by a seeded digest of the key: a projection, the same under any row order and in any engine.

    Folds are near-equal in size, not exactly equal.
    """
    first = F.conv(F.substring(key_digest(key, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(out, (first % k).cast("int"))


def stratified_folds(
    df: DataFrame,
    key: Sequence[str],
    label: str,
    k: int = FOLDS,
    seed: int = SEED,
    out: str = "fold",
) -> DataFrame:
    """Folds with the same class mix, sizes differing by at most one row per class.

    Rows are dealt out in hash order within their class.  A class may hold most
    of the rows, so positions come from range-partitioned sorting.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*key, F.lit(seed)))
    placed = row_positions(hashed, ["__hash", *key], [label], "__place")
    return placed.withColumn(out, F.pmod("__place", F.lit(k)).cast("int")).drop("__hash", "__place")
