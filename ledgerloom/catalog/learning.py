"""Learning queries over documents and their labels.

Documents without a label are the rows to score.  Features are counts over the
whole text and indicators of language and source.
"""

from __future__ import annotations

from collections.abc import Callable

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import learn
from .. import operators as O
from .. import plans
from ..sources import drop_scratch, free_files, load_params, read_csv, read_snapshot, save_params, scratch_path, write_csv, write_snapshot
from .basics import wide_snapshot
from .standins import load

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Shorter runs than the defaults; ``rounds``, ``max_depth`` and ``k`` are the parameters to raise.
_SETTINGS = learn.BoostSettings(rounds=8, max_depth=4, learning_rate=0.1, min_gain=0.0)
_K = 4


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents").selectExpr(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        "size(split(text, ' ')) AS words",
        "regexp_count(text, '\\n') AS lines",
        "length(regexp_replace(text, '[^0-9]+', '')) AS digits",
        "length(regexp_replace(text, '[^A-Z]+', '')) AS capitals",
        "regexp_count(text, '[.!?]') AS stops",
    )
    return documents.join(load(spark, d, "labels").drop("toxic"), "doc_id", "left")


def _matrix(spark: SparkSession, d: str) -> learn.FeatureMatrix:
    encoded, _ = O.one_hot_encoder(_labelled(spark, d), ["lang", "source"], null_column=False)
    path = scratch_path(spark, "features")
    write_snapshot(encoded, path)
    return learn.build_matrix(read_snapshot(spark, path), "doc_id", "quality")


@query
def ml_fold_assign(spark, d):
    return learn.assign_folds(load(spark, d, "labels"), ["doc_id"])


ORACLE["ml_fold_assign"] = (
    "SELECT *, CAST(CAST('0x' || left(md5(doc_id || '|1001'), 8) AS BIGINT) % 10 AS INTEGER) AS fold FROM labels"
)


@query
def ml_fold_stratified(spark, d):
    """Rows per class and fold: as equal as they can be."""
    folded = learn.stratified_folds(load(spark, d, "labels"), ["doc_id"], "quality")
    return folded.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n"))


ORACLE["ml_fold_stratified"] = (
    "SELECT quality, fold, count(*) AS n FROM (SELECT quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 10 "
    "AS INTEGER) AS fold FROM labels) GROUP BY quality, fold"
)


@query
def ml_gbt(spark, d):
    """One model stopped by a held-out fold, scoring every document."""
    matrix = _matrix(spark, d)
    folded = learn.assign_folds(matrix.labelled(), ["doc_id"], _K).withColumn("held_out", F.col("fold") == 0)
    model = learn.boosted_model(folded, "quality", _SETTINGS, "held_out")
    return learn.score_rows(matrix.df, [model], ["doc_id", "quality"], "score")


@query
def ml_kfold(spark, d):
    """Out-of-fold scores of labelled documents and averaged scores of the others."""
    result = learn.train_kfold(_matrix(spark, d), _SETTINGS, _K)
    return O.union_all_by_name(result.out_of_fold, result.scores)


@query
def ml_kfold_metrics(spark, d):
    """AUC and best round of each of the ten folds."""
    return learn.train_kfold(_matrix(spark, d), _SETTINGS, stratified=True).folds


@query
def pipe_train(spark, d):
    """Wide table, pruned, trained under k-fold, refit at the best round, and the rows without a label scored."""
    wide, path = scratch_path(spark, "wide"), scratch_path(spark, "pruned")
    write_snapshot(plans.prune(wide_snapshot(spark, d, wide)), path)
    drop_scratch(spark, wide)
    free_files(spark)
    matrix = learn.build_matrix(read_snapshot(spark, path), "SK_ID_CURR", "TARGET")
    model = learn.refit_best(matrix, learn.train_kfold(matrix, _SETTINGS, _K), _SETTINGS)
    return learn.score_rows(matrix.unlabelled(), [model], ["SK_ID_CURR"], "TARGET")


@query
def ml_importance(spark, d):
    """Importances of the features with the largest means."""
    table = learn.train_kfold(_matrix(spark, d), _SETTINGS, _K).importances
    return O.semi_join_top(table, "feature", "importance", 40)


@query
def ml_refit(spark, d):
    """Final model with the best fold's rounds."""
    matrix = _matrix(spark, d)
    model = learn.refit_best(matrix, learn.train_kfold(matrix, _SETTINGS, _K), _SETTINGS)
    return learn.score_rows(matrix.unlabelled(), [model], ["doc_id"], "score")


def _saved_model(matrix: learn.FeatureMatrix, spark: SparkSession) -> str:
    path = scratch_path(spark, "model")
    learn.boosted_model(matrix.labelled(), "quality", _SETTINGS).write().overwrite().save(path)
    return path


@query
def ml_save_load(spark, d):
    matrix = _matrix(spark, d)
    model = GBTClassificationModel.load(_saved_model(matrix, spark))
    return learn.score_rows(matrix.labelled(), [model], ["doc_id", "quality"], "score")


@query
def ml_score(spark, d):
    """Batch scoring with a saved model into an id and probability file."""
    matrix = _matrix(spark, d)
    model = GBTClassificationModel.load(_saved_model(matrix, spark))
    path = scratch_path(spark, "predictions")
    write_csv(learn.score_rows(matrix.unlabelled(), [model], ["doc_id"], "quality"), path)
    return read_csv(spark, path, "doc_id bigint, quality double")


@query
def ml_grid_search(spark, d):
    """Two by two grid; the winner is stored, read back, refit, and its AUC on all labelled rows put beside the grid."""
    matrix = _matrix(spark, d)
    params, table = learn.tune(matrix, {"learning_rate": [0.01, 0.1], "n_estimators": [8, 4]}, k=3, settings=_SETTINGS)
    path = scratch_path(spark, "params")
    save_params(spark, params, path)
    model = learn.refit_from_params(matrix, load_params(spark, path), _SETTINGS)
    scored = learn.score_rows(matrix.labelled(), [model], ["doc_id", "quality"], "score")
    return table.withColumn("refit_auc", F.lit(O.roc_auc(scored, "quality", "score").first()["auc"]))


# Shorter runs than the published ones, whose settings are the defaults.
_BOOST = learn.HistogramSettings(learning_rate=0.1, rounds=40, max_depth=4, min_child_weight=1.0, patience=5)
_KEYS = ("doc_id", "quality")


def _numbers(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    encoded, _ = O.one_hot_encoder(_labelled(spark, d), ["lang", "source"], null_column=False)
    path = scratch_path(spark, "numbers")
    write_snapshot(encoded, path)
    return read_snapshot(spark, path), [c for c in encoded.columns if c not in _KEYS]


@query
def ml_boost_stop(spark, d):
    """Per fold: AUC, the round kept, and the rounds trained until five in a row gained nothing."""
    df, features = _numbers(spark, d)
    return learn.train_folds(df, "doc_id", "quality", features, _BOOST, _K).folds


@query
def ml_boost_saved(spark, d):
    """Refit at the best fold's round, saved, loaded, and applied to the rows without a label."""
    df, features = _numbers(spark, d)
    short = replace(_BOOST, rounds=8)
    model = learn.refit(df, "quality", features, learn.train_folds(df, "doc_id", "quality", features, short, _K), short)
    path = scratch_path(spark, "booster")
    model.save(spark, path)
    return learn.score_models(df.where("quality IS NULL"), ["doc_id"], [learn.HistogramModel.load(spark, path)])


@query
def ml_tune_staged(spark, d):
    """The published rates and folds, a tenth of the published rounds: four settings from two fits a fold."""
    df, features = _numbers(spark, d)
    grid = {"learning_rate": learn.GRID["learning_rate"], "n_estimators": [n // 10 for n in learn.GRID["n_estimators"]]}
    return learn.tune_staged(df, "doc_id", "quality", features, grid, learn.TUNING_FOLDS, _BOOST)[1]


def _categories(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents").selectExpr("doc_id", "lang", "source", "left(text, 2) AS head", "left(text, 3) AS start")
    return documents.join(load(spark, d, "labels").select(*_KEYS), "doc_id", "left")


@query
def encode_saved_apply(spark, d):
    """Encoders fitted on labelled rows, saved, loaded, and applied to the others, whose values they may not know."""
    rows = _categories(spark, d)
    encoder = learn.Encoder(oneHot=["lang"], label=["start"], rare=["head"], minShare=0.02, rareLabel="other")
    path = scratch_path(spark, "encoder")
    Pipeline(stages=[encoder]).fit(rows.where("quality IS NOT NULL")).write().overwrite().save(path)
    return PipelineModel.load(path).transform(rows.where("quality IS NULL")).drop("quality")


ORACLE["encode_saved_apply"] = """
WITH d AS (SELECT doc_id, lang, source, left(text, 2) AS head, left(text, 3) AS start, quality FROM documents LEFT JOIN labels USING (doc_id)),
t AS (SELECT * FROM d WHERE quality IS NOT NULL),
common AS (SELECT head FROM t WHERE head IS NOT NULL GROUP BY head HAVING count(*) / (SELECT count(*) FROM t) >= 0.02),
many AS (SELECT count(DISTINCT head) > 4 AS yes FROM t),
codes AS (SELECT start, CAST(row_number() OVER (ORDER BY start) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT start FROM t WHERE start IS NOT NULL))
SELECT doc_id, source, CASE WHEN head IS NULL OR NOT yes OR head IN (SELECT head FROM common) THEN head ELSE 'other' END AS head, code AS start,
""" + ", ".join(f"CAST(lang = '{v}' AS INTEGER) AS lang_{v}" for v in ("de", "en", "es", "fr")) + """, CAST(lang IS NULL AS INTEGER) AS lang_nan
FROM d LEFT JOIN codes USING (start), many WHERE quality IS NULL
"""


@query
def select_features(spark, d):
    """Features by tree importance, one of each correlated group, and categories that depend on the label."""
    # The texts are read once: the stored rows hold the counts, and the categories need no text.
    stored, _ = _numbers(spark, d)
    importance = learn.mean_importance(learn.tree_importances(learn.build_matrix(stored, "doc_id", "quality"), _SETTINGS))
    numeric = ["n_chars", "words", "lines", "digits", "capitals", "stops"]
    return learn.select_features(stored, "quality", numeric, ["lang", "source"], importance, category_rows=_labelled(spark, d))


@query
def select_tree_importance(spark, d):
    return learn.mean_importance(learn.tree_importances(_matrix(spark, d), _SETTINGS))


@query
def select_chi_squared(spark, d):
    return learn.categorical_dependence(_labelled(spark, d), ["lang", "source"], "quality")

