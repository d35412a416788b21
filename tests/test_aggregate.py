import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import operators as O

ROWS = [
    ("a", 1.0, "x"), ("a", 2.0, "y"), ("a", 4.0, None), ("a", 4.0, "x"),
    ("b", 5.0, "x"),
    ("c", None, "y"), ("c", None, "y"),
    ("d", 3.0, "x"), ("d", 3.0, "x"), ("d", 3.0, "y"), ("d", 3.0, "y"),
    ("e", 1.0, "x"), ("e", 9.0, "x"),
    (None, 7.0, "x"),
]


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(ROWS, "k string, v double, c string")


@pytest.fixture(scope="module")
def frame():
    return pd.DataFrame(ROWS, columns=["k", "v", "c"])


@pytest.mark.parametrize("function", ["min", "max", "mean", "sum", "var", "std", "median", "skew", "count", "nunique"])
def test_functions_match_pandas(groups, frame, function):
    got = {r["k"]: r[1] for r in O.summarize(groups, ["k"], {"v": [function]}).collect()}
    expected = frame.groupby("k")["v"].agg(function)
    assert set(got) == set(expected.index)
    for k, v in expected.items():
        assert (got[k] is None) if pd.isna(v) else got[k] == pytest.approx(v)


def test_nan_is_null_and_large_sums_do_not_overflow(spark):
    df = spark.createDataFrame([(1, float("nan"), 2**62), (1, 2.0, 2**62), (1, None, 2**62)], "k int, v double, n bigint")
    row = O.summarize(df, ["k"], {"v": ["max", "mean", "sum", "median", "count", "nunique"], "n": ["sum"]}).first()
    assert tuple(row)[1:] == (2.0, 2.0, 2.0, 1, 1, 3.0 * 2**62, 2.0)


def test_decimals_and_booleans_are_in_every_column(spark):
    df = spark.createDataFrame([(1, True), (1, False)], "k int, b boolean").withColumn("d", F.lit("1.50").cast("decimal(5,2)"))
    spec = O.every_column(df, ["k"], ["sum"])
    assert list(spec) == ["b", "d"]
    assert [float(x) for x in tuple(O.summarize(df, ["k"], spec).first())[1:]] == [1.0, 3.0]


def test_size_counts_rows_and_null_keys_are_left_out(groups):
    got = {r["k"]: r["v_SIZE"] for r in O.summarize(groups, ["k"], {"v": ["size"]}).collect()}
    assert got == {"a": 4, "b": 1, "c": 2, "d": 4, "e": 2}


def test_all_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2), ("c", None)], "k string, v int")
    got = {r["k"]: r["v_ALL"] for r in O.summarize(df, ["k"], {"v": ["all"]}).collect()}
    assert got == {"a": False, "b": True, "c": True}


def test_subset_equals_filter_aggregate_and_left_join(groups):
    spec = {"v": ["sum", "mean", "var", "size", "count", "nunique", "median"]}
    one_pass = O.summarize(groups, ["k"], {}, subsets=[O.Subset("X_", F.col("c") == "x", spec)])
    apart = groups.select("k").where("k IS NOT NULL").distinct().join(
        O.summarize(groups.where("c = 'x'"), ["k"], spec, "X_"), "k", "left"
    )
    order = ["k", *[f"X_v_{f.upper()}" for f in spec["v"]]]
    assert sorted(map(tuple, one_pass.select(order).collect()), key=str) == sorted(
        map(tuple, apart.select(order).collect()), key=str
    )


def test_shares_equal_means_of_dummies(groups, frame):
    shares = O.Shares({"c": ["x", "y", None]}, ["mean", "sum", "max", "min", "var"])
    got = {r["k"]: r for r in O.summarize(groups, ["k"], {}, "P_", shares).collect()}
    dummies = pd.get_dummies(frame, columns=["c"], dummy_na=True, dtype=float)
    for column in ("c_x", "c_y", "c_nan"):
        for function in ("mean", "sum", "max", "min", "var"):
            for k, v in dummies.groupby("k")[column].agg(function).items():
                value = got[k][f"P_{column}_{function.upper()}"]
                assert (value is None) if pd.isna(v) else value == pytest.approx(v)


def test_empty_input_gives_no_rows(groups):
    empty = groups.where("1 = 0")
    assert O.summarize(empty, ["k"], {"v": ["mean", "median"]}).count() == 0


def test_infinities_that_cancel_give_null(spark):
    df = spark.createDataFrame([("a", float("inf")), ("a", float("-inf")), ("b", float("inf"))], "k string, v double")
    got = {r["k"]: r for r in O.summarize(df, ["k"], {"v": ["mean", "sum", "var"]}).collect()}
    assert got["a"]["v_MEAN"] is None and got["a"]["v_SUM"] is None
    assert got["b"]["v_MEAN"] == float("inf")


def test_first_row_and_argmax_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), ("b", 4, None)], "k string, i int, v double")
    assert {r["k"]: r["i"] for r in O.first_per_key(df, ["k"], ["i"]).collect()} == {"a": 1, "b": 4}
    assert {r["k"]: r["i"] for r in O.argmax_row(df, ["k"], "v", ["i"]).collect()} == {"a": 2, "b": 4}


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    plan = O.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_counting_helpers(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 2, 1), ("a", None, 1)], "k string, v int, m int")
    row = df.groupBy("k").agg(O.count_nonzero("v").alias("n"), O.percent_below("v", "m").alias("p")).first()
    assert row["n"] == 2
    assert row["p"] == pytest.approx(100 / 3)


def test_every_column_takes_numeric_columns_only(groups):
    assert O.every_column(groups, ["k"], ["min"]) == {"v": ["min"]}


@pytest.mark.parametrize("hot_rows", [5_000_000, 3])
def test_dealt_rows_give_the_same_aggregates_and_hot_keys_are_combined(spark, hot_rows):
    df = spark.range(60).selectExpr("CASE WHEN id < 40 THEN 1 WHEN id < 58 THEN id % 5 + 2 END AS k", "id % 7 AS v", "id % 3 = 0 AS f", "string(id % 2) AS c")
    spec = {"v": ["min", "mean", "sum", "nunique"], "f": ["sum"]}
    args = (["k"], spec, "P_", O.Shares({"c": ["0", None]}), [O.Subset("S_", F.col("v") > 3, {"v": ["max", "count"]})])
    plain, dealt = O.summarize(df, *args), O.summarize(df, *args, deal=True, hot_rows=hot_rows)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
    aggregates = O.summarize(df, ["k"], {"v": ["min", "mean"]}, deal=True, hot_rows=hot_rows, counted=df.select("k"))
    moves = aggregates._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert moves == (1 if hot_rows > 60 else 2)


@pytest.mark.parametrize("name", ["pos_two_level", "instalments_two_level"])
def test_wide_recipes_move_rows_not_buffers(spark, sf_dir, name):
    from ledgerloom import plans
    from ledgerloom.catalog.standins import CreditTables

    t = CreditTables(spark, sf_dir)
    table = {"pos": "POS_CASH_balance", "ins": "installments_payments", "pre": "previous_application"}[name[:3]]
    plan = getattr(plans, name)(t[table])._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    # The last aggregate follows its own partial form without an exchange between them.
    lines = [line for line in plan.splitlines() if "HashAggregate" in line or "Exchange" in line]
    assert all("HashAggregate" in line for line in lines[:2])


@pytest.mark.parametrize("name", ["instalment_base"])
def test_distinct_counts_over_few_rows_move_rows_not_buffers(spark, sf_dir, name):
    from ledgerloom import plans
    from ledgerloom.catalog.standins import CreditTables

    plan = getattr(plans, name)(CreditTables(spark, sf_dir)["installments_payments"])._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    lines = [line for line in plan.splitlines() if "HashAggregate" in line or "Exchange" in line]
    assert all("HashAggregate" in line for line in lines[:4])


_WIDE_RECIPES = {
    "bureau_base": ("bureau", "bureau_balance"),
    "bureau_score": ("bureau", "bureau_balance"),
    "bureau_skew": ("bureau", "bureau_balance"),
    "bureau_ratios": ("bureau", "bureau_balance"),
    "card_base": ("credit_card_balance",),
    "card_nulled": ("credit_card_balance",),
}


@pytest.mark.parametrize("name", sorted(_WIDE_RECIPES))
def test_one_level_wide_recipes_move_rows_not_buffers(spark, sf_dir, name):
    from ledgerloom import plans
    from ledgerloom.catalog.standins import CreditTables

    t = CreditTables(spark, sf_dir)
    plan = getattr(plans, name)(*[t[n] for n in _WIDE_RECIPES[name]])._jdf.queryExecution().executedPlan().toString()
    # The joins of the wide tables follow in the tasks of the credits, which are not merged.
    assert ("REPARTITION_BY_NUM" if name.startswith("bureau") else "REPARTITION_BY_COL") in plan
    lines = [line for line in plan.splitlines() if "HashAggregate" in line or "Exchange" in line]
    assert all("HashAggregate" in line for line in lines[:2])


@pytest.mark.parametrize("hot_rows", [5_000_000, 3])
def test_medians_of_dealt_rows_need_no_order_over_all_rows(groups, monkeypatch, hot_rows):
    from ledgerloom.operators import aggregate

    spec, subsets = {"v": ["median", "mean"]}, [O.Subset("X_", F.col("c") == "x", {"v": ["median"]})]
    plain = sorted(map(tuple, O.summarize(groups, ["k"], spec, subsets=subsets).collect()))
    ordered = []
    quantiles = aggregate.group_quantiles
    monkeypatch.setattr(aggregate, "group_quantiles", lambda long, *a: ordered.append({r["k"] for r in long.collect()}) or quantiles(long, *a))
    dealt = O.summarize(groups, ["k"], spec, subsets=subsets, deal=True, hot_rows=hot_rows)
    assert sorted(map(tuple, dealt.collect())) == plain
    # Only keys above the bound go by order over many tasks.
    assert ordered == ([] if hot_rows > 3 else [{"a", "d"}])
