import math

from pyspark.sql import functions as F

from ledgerloom import functions as X


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_safe_div_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None)], "a double, b double")
    assert one(df, X.safe_div("a", "b")) == [0.5, None, None, None, None, None]
    assert one(df, X.safe_div("a", "b", "ieee")) == [0.5, math.inf, -math.inf, None, None, None]


def test_safe_div_takes_integers_and_odd_names(spark):
    df = spark.createDataFrame([(3, 2)], "`a.b c` int, `d/e` int")
    assert one(df, X.safe_div("a.b c", "d/e")) == [1.5]


def test_clip_flag_and_cap_with_null(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (None,)], "x double")
    assert one(df, X.clip_zero("x")) == [0.0, 0.0, 2.0, 0.0]
    assert one(df, X.flag(F.col("x") < 0)) == [1, 0, 0, 0]
    assert one(df, X.cap_above("x", 1.0, 9.0)) == [-1.0, 0.0, 9.0, None]


def test_sign_label_has_a_null_branch(spark):
    df = spark.createDataFrame([(-2,), (0,), (5,), (None,)], "x int")
    assert one(df, X.sign_label("x", "neg", "zero", "pos", "none")) == ["neg", "zero", "pos", "none"]
    assert one(df, X.sign_label("x", 0, 0, 1, None)) == [0, 0, 1, None]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (30.0,), (30.1,), (99.0,), (None,)], "x double")
    assert one(df, X.bin_right_closed("x", [20.0, 30.0], ["a", "b"])) == [None, "a", "a", "b", "b", None]


def test_overwrite_last_rule_wins(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (None, None)], "a int, b int")
    rules = [(F.col("a") == 1, 10), (F.col("b") == 1, 20)]
    assert one(df, X.overwrite(F.lit(None).cast("int"), rules, default=0)) == [20, 10, 0, 0]


def test_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-1.5,)], "x double")
    assert one(df, X.round_even("x")) == [0.0, 2.0, 2.0, 0.0, -2.0]


def test_xor_score_matches_python(spark):
    rows = [(1, 2, 3, 4, 5), (0, 0, 0, 0, 0), (7, 1, 0, 2, 9)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint, d bigint, e bigint")
    expected = [a + b ^ 2 + c ^ 3 + d ^ 4 + e ^ 5 for a, b, c, d, e in rows]
    assert one(df, X.xor_score("a", "b", "c", "d", "e")) == expected


def test_row_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, None), (None, None)], "a double, b double")
    assert one(df, X.row_mean("a", "b")) == [2.0, 1.0, None]


def test_to_long_truncates_and_guards(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (float("nan"),), (1e300,), (None,)], "x double")
    assert one(df, X.to_long("x")) == [2, -2, None, None, None]


def test_codes_bands_and_groups(spark):
    df = spark.createDataFrame([("X",), ("C",), ("3",), (None,)], "s string")
    assert one(df, X.code_to_int("s", ["X", "C"])) == [0, 0, 3, None]
    assert one(df, X.regroup("s", ["X", "C"], "z")) == ["z", "z", "3", None]
    assert one(df, X.is_member("s", ["X"])) == [True, False, False, False]
    assert one(df, X.not_equal_keep_null("s", "X")) == [False, True, True, True]
    hours = spark.createDataFrame([(8,), (17,), (18,), (None,)], "h int")
    assert one(hours, X.band_between("h", 8, 17, "in", "out")) == ["in", "in", "out", None]


def test_null_rules(spark):
    df = spark.createDataFrame([(1.0,), (365243.0,), (-30000.0,), (float("inf"),), (None,)], "x double")
    assert one(df, X.null_when_in("x", [365243.0]))[1] is None
    assert one(df, X.null_when_in("x", [365243.0, 1.0]))[:2] == [None, None]
    assert one(df, X.null_below("x", -20000))[2] is None
    assert one(df, X.fill_infinite("x"))[3] == 0.0
