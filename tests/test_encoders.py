import pytest
from pyspark.ml import Pipeline, PipelineModel

from ledgerloom.learn import Encoder, EncoderModel, correlated_groups, keep_most_important, keep_order

TRAIN = [(1, "b", "x", "m", 1.0), (2, "a", "y", "f", 2.0), (3, "b", None, "m", 3.0), (4, "c", "x", "m", 4.0), (5, None, "x", "f", 5.0), (6, "b", "z", None, 6.0)]
LATER = [("q", 7.0, "zz", 7, "x", "m"), ("b", 8.0, None, 8, None, None), (None, 9.0, "x", 9, "z", "f")]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, "k int, `a.b` string, c string, sex string, v double").repartition(3)


@pytest.fixture(scope="module")
def later(spark):
    return spark.createDataFrame(LATER, "`a.b` string, v double, c string, k int, other string, sex string")


def rows_of(df):
    return {r["k"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("wrapped", [False, True])
def test_saved_encoders_give_the_columns_of_training(train, later, tmp_path, wrapped):
    encoder = Encoder(oneHot=["c"], label=["a.b"], binary=["sex"])
    model = (Pipeline(stages=[encoder]) if wrapped else encoder).fit(train)
    model.write().save(str(tmp_path / "m"))
    again = (PipelineModel if wrapped else EncoderModel).load(str(tmp_path / "m"))
    assert again.transform(later).columns == model.transform(train).columns == ["k", "a.b", "sex", "v", "c_x", "c_y", "c_z", "c_nan"]
    # sex has three values with its null, so it stays; unknown values have no code and no indicator.
    assert rows_of(again.transform(later)) == {7: (None, "m", 7.0, 0, 0, 0, 0), 8: (1, None, 8.0, 0, 0, 0, 1), 9: (None, "f", 9.0, 1, 0, 0, 0)}
    assert rows_of(again.transform(train))[4] == (2, "m", 4.0, 1, 0, 0, 0)


def test_codes_by_appearance_and_two_values(train, later):
    known = train.where("sex IS NOT NULL")
    model = Encoder(firstSeen=["a.b"], order="k", binary=["sex"]).fit(known)
    assert {k: v[0] for k, v in rows_of(model.transform(known)).items()} == {1: 0, 2: 1, 3: 0, 4: 2, 5: -1}
    got = rows_of(model.transform(later))
    assert [got[k][0] for k in (7, 8, 9)] == [-1, 0, -1] and [got[k][2] for k in (7, 8, 9)] == [1, None, 0]


def test_rare_values_are_those_of_training(train, later):
    model = Encoder(rare=["a.b", "c"], minShare=0.3, minCategories=2).fit(train)
    assert [rows_of(model.transform(later))[k][:2] for k in (7, 8, 9)] == [("Rare", "Rare"), ("b", None), (None, "x")]


def test_many_codes_come_from_a_table(spark, tmp_path):
    train = spark.range(1000).selectExpr("id AS k", "lpad(string(id), 4, '0') AS v")
    model = Encoder(label=["v"]).fit(train)
    model.write().save(str(tmp_path / "m"))
    later = spark.createDataFrame([(1, "0500"), (2, "nope"), (3, None)], "k int, v string")
    assert rows_of(EncoderModel.load(str(tmp_path / "m")).transform(later)) == {1: (500,), 2: (None,), 3: (None,)}


def test_empty_tables_and_errors(spark, train, later):
    model = Encoder(oneHot=["c"], label=["sex"], nullColumn=False).fit(train.limit(0))
    assert model.transform(later).columns == ["k", "a.b", "sex", "v"] and model.transform(later.limit(0)).count() == 0
    assert keep_order(model, ["k"]) == ["a.b", "sex", "v"]
    assert Encoder().fit(train).transform(train).columns == train.columns
    with pytest.raises(ValueError, match="more than one"):
        Encoder(oneHot=["c"], label=["c"]).fit(train)
    with pytest.raises(ValueError, match="order"):
        Encoder(firstSeen=["c"]).fit(train)
    with pytest.raises(ValueError, match="missing: c"):
        Encoder(label=["c"]).fit(train).transform(later.drop("c"))
    with pytest.raises(ValueError, match="more than 2 distinct"):
        Encoder(oneHot=["c"], limit=2).fit(train)


def test_correlated_groups_keep_the_most_important(spark):
    pairs = spark.createDataFrame([("a", "b", 0.9), ("b", "d", -0.8), ("c", "e", 0.75), ("a", "c", None)], "column_a string, column_b string, corr double")
    groups = correlated_groups(pairs, list("abcde"))
    assert groups == {"a": "a", "b": "a", "c": "c", "d": "a", "e": "e"}
    assert keep_most_important(groups, {"d": 0.5, "a": 0.5, "b": 0.1, "c": 1.0}) == ["a", "c", "e"]
    assert keep_most_important(groups, {"d": 0.6, "a": 0.5}) == ["c", "d", "e"]
