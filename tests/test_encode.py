import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import operators as O
from ledgerloom.operators.encode import first_seen_codes, learn_counts

VALUES = ["b", "a", None, "it's", "b", "a/b c", "a", "b"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, c string")


@pytest.mark.parametrize("null_column", [True, False])
@pytest.mark.parametrize("drop_first", [True, False])
def test_one_hot_matches_pandas(df, null_column, drop_first):
    got, names = O.one_hot_encoder(df, ["c"], null_column, drop_first)
    expected = pd.get_dummies(pd.DataFrame({"c": VALUES}), columns=["c"], dummy_na=null_column, drop_first=drop_first)
    assert names == list(expected.columns)
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [tuple(map(int, r)) for r in expected.to_numpy()]


def test_null_column_is_made_without_nulls_and_rows_sum_to_one(df):
    got, names = O.one_hot_encoder(df.na.fill("z"), ["c"])
    assert names[-1] == "c_nan"
    sums = {sum(tuple(r)[1:]) for r in got.collect()}
    assert sums == {1}


def test_factorize_matches_pandas_inline_and_joined(df):
    expected, _ = pd.factorize(pd.Series(VALUES))
    one_pass = O.first_seen_encode(df, ["c"], F.col("i")).orderBy("i").collect()
    assert [r["c"] for r in one_pass] == list(expected)
    joined = first_seen_codes(df, "c", "i", inline_limit=1).apply(df, "code", hot_rows=2)
    assert [r["code"] for r in joined.orderBy("i").collect()] == list(expected)


def test_label_codes_are_alphabetical(df):
    order = sorted({v for v in VALUES if v is not None})
    expected = [None if v is None else order.index(v) for v in VALUES]
    assert [r["c"] for r in O.label_encode(df, ["c"]).orderBy("i").collect()] == expected
    joined = O.label_codes(df, "c", inline_limit=0).apply(df, "code")
    assert [r["code"] for r in joined.orderBy("i").collect()] == expected


def test_binary_label_encoding_counts_null_as_a_value(spark):
    rows = [("a", "x", "p"), ("b", None, "q"), ("a", "x", "r")]
    df, done = O.label_encode_binary(spark.createDataFrame(rows, "two string, one string, three string"))
    assert done == ["two", "one"]
    assert [tuple(r) for r in df.collect()] == [(0, 0, "p"), (1, 1, "q"), (0, 0, "r")]


def test_rare_labels(spark):
    values = ["a"] * 50 + ["b"] * 30 + ["c"] * 16 + ["d"] * 2 + ["e"] * 1 + [None]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    counts = {r["c"]: r["count"] for r in O.rare_labels(df, ["c"]).groupBy("c").count().collect()}
    assert counts == {"a": 50, "b": 30, "c": 16, "Rare": 3, None: 1}
    few = df.where("c IN ('a', 'b', 'e')")
    assert O.rare_labels(few, ["c"]).where("c = 'Rare'").count() == 0
    percent = O.rare_labels_percent(df, {"c": 1.0}).groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in percent} == {"a": 50, "b": 30, "c": 16, "d": 2, "Rare": 2}


def test_too_many_categories_is_an_error_not_a_cut(df):
    with pytest.raises(ValueError, match="more than 2 distinct values in c"):
        learn_counts(df, ["c"], limit=2)


def test_the_limit_is_per_column(df):
    both = df.withColumn("d", F.col("i").cast("string"))
    assert {c: len(v) for c, v in learn_counts(both, ["c", "d"], limit=8).items()} == {"c": 5, "d": 8}


def test_many_values_are_coded_by_a_table(spark):
    values = [f"v{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(i, v, "ab"[i % 2]) for i, v in enumerate(reversed(values))], "i int, many string, few string")
    coded = O.label_encode(df, ["many", "few"])
    assert [r["many"] for r in coded.orderBy("i").collect()] == list(range(499, -1, -1))
    assert {r["few"] for r in coded.collect()} == {0, 1}


def test_sparse_one_hot_has_a_one_per_row_and_column(df):
    ones, values = O.one_hot_sparse(df, ["i"], ["c"])
    names = {r["index"]: r["value"] for r in values.collect()}
    assert [names[r["index"]] for r in ones.orderBy("i").collect()] == VALUES
    assert sorted(names) == list(range(len(set(VALUES))))
