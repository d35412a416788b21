import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from ledgerloom import learn
from ledgerloom import operators as O
from ledgerloom.sources import load_params, save_params

SETTINGS = learn.BoostSettings(rounds=4, max_depth=3, learning_rate=0.3, min_gain=0.0, feature_share=1.0)


@pytest.fixture(scope="module")
def rows(spark):
    """400 rows: the label follows ``a`` with noise, ``b`` has gaps, 100 rows have no label."""
    df = spark.range(400).withColumnRenamed("id", "k")
    noise = F.pmod(F.xxhash64("k", F.lit(5)), F.lit(100))
    return df.select(
        "k",
        F.pmod(F.xxhash64("k", F.lit(1)), F.lit(100)).cast("double").alias("a"),
        F.when(F.col("k") % 3 > 0, F.pmod(F.xxhash64("k", F.lit(2)), F.lit(9)).cast("double")).alias("b"),
        F.when(F.col("k") % 7 == 0, F.lit(float("inf"))).otherwise(F.lit(1.0)).alias("c d"),
        noise.alias("noise"),
    ).withColumn("y", F.when(F.col("k") % 4 > 0, (F.col("a") + F.col("noise") / 4 > 60).cast("int"))).drop("noise")


@pytest.fixture(scope="module")
def matrix(rows):
    return learn.build_matrix(rows, "k", "y")


def test_folds_partition_the_rows(rows):
    folds = learn.assign_folds(rows, ["k"], 5).groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == set(range(5))
    assert sum(r["count"] for r in folds) == 400
    again = learn.assign_folds(rows.repartition(7), ["k"], 5)
    assert learn.assign_folds(rows, ["k"], 5).exceptAll(again).count() == 0


def test_stratified_folds_balance_each_class(rows):
    folded = learn.stratified_folds(rows.where("y IS NOT NULL"), ["k"], "y", 5)
    counts = folded.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_matrix_flags_gaps_and_holds_finite_values(matrix):
    assert matrix.features == ["a", "b", "cd", "b_missing"]
    values = [r["features"].toArray() for r in matrix.df.collect()]
    assert all(abs(v).max() <= 1e30 for v in values)
    assert matrix.labelled().count() == 300 and matrix.unlabelled().count() == 100


def test_kfold_scores_every_row_once(matrix):
    result = learn.train_kfold(matrix, SETTINGS, k=3)
    assert result.out_of_fold.count() == 300 == result.out_of_fold.select("k").distinct().count()
    assert result.scores.count() == 100
    assert result.overall_auc > 0.8
    folds = result.folds.collect()
    assert {r["fold"] for r in folds} == {0, 1, 2} and all(r["auc"] > 0.7 for r in folds)
    table = result.importances
    assert table.count() == 3 * len(matrix.features)
    best = O.semi_join_top(table, "feature", "importance", 1)
    assert {r["feature"] for r in best.collect()} == {"a"}
    assert table.where("feature = 'a'").agg(F.min("splits")).first()[0] > 0
    assert learn.refit_best(matrix, result, SETTINGS).getNumTrees <= SETTINGS.rounds


def test_averaged_scores_equal_the_mean_of_single_scores(matrix):
    models = [learn.boosted_model(matrix.labelled(), "y", SETTINGS.with_rounds(n)) for n in (1, 2)]
    both = {r["k"]: r["s"] for r in learn.score_rows(matrix.unlabelled(), models, ["k"], "s").collect()}
    single = [{r["k"]: r["s"] for r in learn.score_rows(matrix.unlabelled(), [m], ["k"], "s").collect()} for m in models]
    assert all(both[k] == pytest.approx((single[0][k] + single[1][k]) / 2) for k in both)


def test_saved_model_scores_the_same(matrix, tmp_path):
    model = learn.boosted_model(matrix.labelled(), "y", SETTINGS)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = GBTClassificationModel.load(str(tmp_path / "m"))
    a = learn.score_rows(matrix.df, [model], ["k"], "s").orderBy("k").collect()
    assert a == learn.score_rows(matrix.df, [loaded], ["k"], "s").orderBy("k").collect()


def test_patience_looks_on_after_the_best_round():
    losses = [0.9, 0.8, 0.85, 0.7, 0.75, 0.76, 0.77, 0.6]
    assert learn.best_round(losses, patience=1) == 2
    assert learn.best_round(losses, patience=2) == 4
    assert learn.best_round(losses, patience=4) == 8


def test_a_model_cut_short_is_the_model_of_fewer_rounds(matrix):
    long = learn.boosted_model(matrix.labelled(), "y", SETTINGS)
    cut, short = learn.first_rounds(long, 2), learn.boosted_model(matrix.labelled(), "y", SETTINGS.with_rounds(2))
    assert cut.getNumTrees == 2
    a, b = ({r["k"]: r["s"] for r in learn.score_rows(matrix.df, [m], ["k"], "s").collect()} for m in (cut, short))
    assert a == pytest.approx(b)


def test_a_slow_learner_is_not_stopped_at_once(matrix):
    tagged = learn.assign_folds(matrix.labelled(), ["k"], 4).withColumn("held", F.col("fold") == 0)
    slow = learn.BoostSettings(rounds=14, max_depth=2, min_gain=0.0)
    assert learn.boosted_model(tagged, "y", slow, "held").getNumTrees > 10


def test_tuning_takes_any_known_name_and_no_other(matrix):
    with pytest.raises(ValueError, match="num_leaves"):
        learn.tune(matrix, {"num_leaves": [3]})


def test_booleans_and_decimals_are_features_and_text_is_an_error(spark):
    df = spark.createDataFrame([(1, 0, True), (2, 1, False)], "k int, y int, b boolean").withColumn("d", F.lit("1.50").cast("decimal(5,2)"))
    assert learn.build_matrix(df, "k", "y").features == ["b", "d"]
    with pytest.raises(ValueError, match="encode or exclude these columns first: t"):
        learn.build_matrix(df.withColumn("t", F.lit("x")), "k", "y")


def test_unsupported_settings_are_named():
    assert learn.BoostSettings.from_names({"learning_rate": 0.1, "n_estimators": 7}).rounds == 7
    with pytest.raises(ValueError, match="num_leaves, reg_alpha"):
        learn.BoostSettings.from_names({"num_leaves": 34, "reg_alpha": 0.1})


def test_tuning_and_stored_parameters(spark, matrix, tmp_path):
    params, table = learn.tune(matrix, {"learning_rate": [0.1], "n_estimators": [1, 3]}, k=2, settings=SETTINGS)
    assert table.count() == 2
    save_params(spark, params, str(tmp_path / "p"))
    assert load_params(spark, str(tmp_path / "p")) == params
    assert learn.refit_from_params(matrix, params, SETTINGS).getNumTrees == params["n_estimators"]


def test_selection_tables(spark, rows, matrix):
    top = learn.mean_importance(learn.tree_importances(matrix, SETTINGS, trees=3)).first()
    assert top["feature"] == "a"
    text = rows.withColumn("high", F.when(F.col("a") > 60, "yes").otherwise("no")).withColumn("same", F.lit("z"))
    tests = {r["column"]: r["p_value"] for r in learn.categorical_dependence(text, ["high", "same"], "y").collect()}
    assert tests["high"] < 1e-6 and tests["same"] > 0.9
    assert learn.combine_selection(["a", "b"], ["b"], ["c", "a"]) == ["a", "c"]


def test_feature_selection_reads_each_text_once(spark, sf_dir, monkeypatch):
    from ledgerloom.catalog import learning

    read, load = spark.sparkContext.accumulator(0), learning.load

    @F.udf("string")
    def watched(text):
        read.add(1)
        return text

    def watching(session, folder, name):
        df = load(session, folder, name)
        return df.withColumn("text", watched("text")) if name == "documents" else df

    monkeypatch.setattr(learning, "load", watching)
    chosen = {r["feature"]: r["origin"] for r in learning.select_features(spark, sf_dir).collect()}
    assert "trees" in chosen.values()
    assert read.value == load(spark, sf_dir, "documents").count()


def test_selection_takes_categories_from_other_rows(spark, rows):
    importance = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "feature string, mean double")
    high = F.when(F.col("a") > 60, "yes").otherwise("no")
    whole = learn.select_features(rows.withColumn("high", high), "y", ["a", "b"], ["high"], importance)
    apart = learn.select_features(rows, "y", ["a", "b"], ["high"], importance, category_rows=rows.select("y", high.alias("high")))
    assert apart.collect() == whole.collect()
    assert ("high", "dependence") in [tuple(r) for r in whole.collect()]


def test_folds_train_side_by_side_and_equal_those_trained_apart(matrix, monkeypatch):
    import threading

    from ledgerloom.learn import kfold

    inside, most, gate, fit = [], [], threading.Lock(), kfold.boosted_model

    def watched(*args):
        with gate:
            inside.append(1)
            most.append(len(inside))
        try:
            return fit(*args)
        finally:
            with gate:
                inside.pop()

    monkeypatch.setattr(kfold, "boosted_model", watched)
    together = learn.train_kfold(matrix, SETTINGS, k=3)
    assert max(most) > 1
    most.clear()
    monkeypatch.setattr(kfold, "TOGETHER_BYTES", 1)
    apart = learn.train_kfold(matrix, SETTINGS, k=3)
    assert max(most) == 1
    assert sorted(together.folds.collect()) == sorted(apart.folds.collect())
    assert sorted(together.out_of_fold.collect()) == sorted(apart.out_of_fold.collect())
