"""Feature selection from models and tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import column_correlations
from .boost import BoostSettings, boosted_model
from .features import FeatureMatrix
from .folds import SEED

# Columns correlated above this are represented by one of them (fixed value).
CORRELATION_LIMIT = 0.75


def tree_importances(matrix: FeatureMatrix, settings: BoostSettings | None = None, trees: int = 20) -> DataFrame:
    """Importance of each feature in several tree models: ``model, feature, importance``.

    Each model reads the assembled rows several times before it keeps its own, so they are kept until all are fitted.
    """
    rows = matrix.labelled().persist(StorageLevel.MEMORY_AND_DISK)
    common = {"featuresCol": "features", "labelCol": matrix.label, "seed": SEED}
    try:
        fitted = {
            "boosted": boosted_model(rows, matrix.label, settings or BoostSettings()),
            "forest": RandomForestClassifier(numTrees=trees, **common).fit(rows),
            "tree": DecisionTreeClassifier(**common).fit(rows),
        }
    finally:
        rows.unpersist()
    table = [
        (name, feature, float(value))
        for name, model in fitted.items()
        for feature, value in zip(matrix.features, model.featureImportances.toArray(), strict=True)
    ]
    return rows.sparkSession.createDataFrame(table, "model string, feature string, importance double")


def mean_importance(table: DataFrame, above: float = 0.0) -> DataFrame:
    """Features whose mean importance exceeds a limit, most important first."""
    means = table.groupBy("feature").agg(F.avg("importance").alias("mean"))
    return means.where(F.col("mean") > above).orderBy(F.desc("mean"), "feature")


def categorical_dependence(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Chi-squared test of each category column against the label; null is a category."""
    known = df.where(F.col(label).isNotNull()).na.fill("nan", subset=list(columns))
    codes = [f"{c}__code" for c in columns]
    indexed = StringIndexer(inputCols=list(columns), outputCols=codes).fit(known).transform(known)
    vectors = VectorAssembler(inputCols=codes, outputCol="codes").transform(indexed)
    tests = ChiSquareTest.test(vectors, "codes", label, flatten=True)
    names = F.array(*[F.lit(c) for c in columns])
    return tests.select(
        F.get(names, F.col("featureIndex")).alias("column"),
        F.col("pValue").alias("p_value"),
        F.col("statistic"),
    )


def correlated_groups(pairs: DataFrame, columns: Sequence[str], threshold: float = CORRELATION_LIMIT) -> dict[str, str]:
    """Group of each column: columns linked, also over others, by a correlation above ``threshold`` in size.

    ``pairs`` holds ``column_a, column_b, corr``.  A group is named by its first member in
    the order of ``columns``.  Only linked pairs of columns reach the driver; their number
    does not grow with the rows.
    """
    group = {c: c for c in columns}

    def top(c: str) -> str:
        while group[c] != c:
            group[c] = group[group[c]]
            c = group[c]
        return c

    place = {c: i for i, c in enumerate(columns)}
    for r in pairs.where(F.abs("corr") > F.lit(threshold)).select("column_a", "column_b").collect():
        a, b = sorted((top(r["column_a"]), top(r["column_b"])), key=place.get)
        group[b] = a
    return {c: top(c) for c in columns}


def keep_most_important(groups: Mapping[str, str], importance: Mapping[str, float]) -> list[str]:
    """The most important member of each group, ties to the first; order as in ``groups``."""
    best: dict[str, str] = {}
    for c, g in groups.items():
        if g not in best or importance.get(c, 0.0) > importance.get(best[g], 0.0):
            best[g] = c
    return [c for c, g in groups.items() if best[g] == c]


def select_features(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categories: Sequence[str],
    importance: DataFrame,
    threshold: float = CORRELATION_LIMIT,
    level: float = 0.05,
    category_rows: DataFrame | None = None,
) -> DataFrame:
    """``feature, origin``: what trees want and correlation keeps, then categories that depend on the label.

    ``importance`` holds ``feature, mean``.  Of each group of correlated numeric columns
    the most important stays; features without importance go.  ``df`` is read several times,
    so it should be stored where its columns are dear to compute; ``category_rows`` holds the
    label and the categories where ``df`` does not.
    """
    numeric = list(numeric)
    weight = {r["feature"]: r["mean"] for r in importance.collect()}  # a row per feature
    groups = correlated_groups(column_correlations(df, numeric), numeric, threshold)
    kept = set(keep_most_important(groups, weight))
    wanted = [f for f in sorted(weight, key=lambda f: (-weight[f], f)) if weight[f] > 0]
    dependent = []
    if categories:
        tested = df if category_rows is None else category_rows
        tests = categorical_dependence(tested, list(categories), label).where(F.col("p_value") <= level)
        dependent = [r["column"] for r in tests.orderBy("p_value", "column").collect()]
    chosen = combine_selection(wanted, [c for c in numeric if c not in kept], dependent)
    rows = [(f, "trees" if f in wanted else "dependence") for f in chosen]
    return df.sparkSession.createDataFrame(rows, "feature string, origin string")


def combine_selection(
    by_trees: Sequence[str],
    dropped_by_correlation: Sequence[str],
    by_dependence: Sequence[str],
) -> list[str]:
    """Features the trees want and correlation keeps, then dependent categories not yet in."""
    dropped = set(dropped_by_correlation)
    kept = [f for f in by_trees if f not in dropped]
    return kept + [f for f in by_dependence if f not in kept]
