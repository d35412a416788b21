"""Grid search and refit from stored parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame

from .boost import FIELDS, BoostSettings, boosted_model
from .features import FeatureMatrix
from .folds import assign_folds

# Published tuning grid and fold count (fixed values).
GRID = {"learning_rate": [0.01, 0.1], "n_estimators": [200, 100]}
TUNING_FOLDS = 5


# The MLlib parameter behind each tunable name.
_PARAMS = {
    "learning_rate": "stepSize",
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "min_split_gain": "minInfoGain",
}


def tune(
    matrix: FeatureMatrix,
    grid: Mapping[str, Sequence] | None = None,
    k: int = TUNING_FOLDS,
    settings: BoostSettings | None = None,
    parallelism: int = 2,
) -> tuple[dict, DataFrame]:
    """Best parameters by AUC, and a table with the mean AUC of every setting.

    Any tunable name may be in the grid; an unknown one is an error.
    """
    grid = dict(grid or GRID)
    if unknown := sorted(set(grid) - set(_PARAMS)):
        raise ValueError(f"cannot tune {', '.join(unknown)}; known are {', '.join(_PARAMS)}")
    settings = settings or BoostSettings()
    gbt = settings.classifier(matrix.label)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(_PARAMS[name]), list(values))
    steps = builder.build()
    folded = assign_folds(matrix.labelled(), [matrix.key], k)
    search = CrossValidator(
        estimator=gbt,
        estimatorParamMaps=steps,
        evaluator=BinaryClassificationEvaluator(labelCol=matrix.label, metricName="areaUnderROC", numBins=0),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
    )
    found = search.fit(folded)
    whole = {"n_estimators", "max_depth"}
    rows = [
        (*[(int if name in whole else float)(step[gbt.getParam(_PARAMS[name])]) for name in grid], float(auc))
        for step, auc in zip(steps, found.avgMetrics, strict=True)
    ]
    schema = ", ".join(f"{name} {'int' if name in whole else 'double'}" for name in grid) + ", auc double"
    table = folded.sparkSession.createDataFrame(rows, schema)
    return dict(zip(grid, max(rows, key=lambda r: r[-1]))), table


def refit_from_params(
    matrix: FeatureMatrix, params: Mapping[str, object], settings: BoostSettings | None = None
) -> GBTClassificationModel:
    """Fit all labelled rows with stored parameters."""
    stored = BoostSettings.from_names(params)
    if settings is not None:
        stored = replace(settings, **{FIELDS[name]: getattr(stored, FIELDS[name]) for name in params})
    return boosted_model(matrix.labelled(), matrix.label, stored)
