import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import operators as O


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 300
    x = rng.normal(size=n)
    df = pd.DataFrame(
        {
            "k": np.arange(n),
            "x": x,
            "copy": x,
            "one_off": np.where(np.arange(n) == 17, 99.0, x),
            "plus": 3 * x + 2,
            "minus": -x,
            "gaps": np.where(rng.random(n) < 0.3, np.nan, x + rng.normal(size=n) * 0.1),
            "other": rng.normal(size=n),
            "flat": 4.0,
            "nearly": np.where(np.arange(n) < 4, 1.0, 2.0),
            "mostly": np.where(np.arange(n) < 12, 1.0, 2.0),
            "empty": np.nan,
        }
    )
    return df


@pytest.fixture(scope="module")
def df(spark, frame):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    schema = "k long, " + ", ".join(f"{c} double" for c in frame.columns[1:])
    return spark.createDataFrame(rows, schema).repartition(3, "k")


def test_correlation_matches_pandas(df, frame):
    columns = list(frame.columns[1:])
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in O.column_correlations(df, columns).collect()}
    expected = frame[columns].corr()
    assert len(got) == len(columns) * (len(columns) - 1) // 2
    for (a, b), value in got.items():
        want = expected.loc[a, b]
        assert (value is None) if np.isnan(want) else value == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("held", [1 << 28, 0])
def test_correlation_of_a_thousand_columns_travels_by_tile(spark, monkeypatch, held):
    """Tasks give out a row per pair of tiles, not per pair of columns, and hold no more matrices than they may."""
    from ledgerloom.operators import profile

    monkeypatch.setattr(profile, "HELD", held)
    width, rows = 1000, 60
    values = np.random.default_rng(1).normal(size=(rows, width))
    values[:, 700] = values[:, 3] * 2 + 1
    values[::7, 5] = np.nan
    df = spark.createDataFrame(pd.DataFrame(values, columns=[f"c{i}" for i in range(width)])).repartition(2)
    wanted = pd.DataFrame(values).corr().to_numpy()
    pairs = O.column_correlations(df).withColumn("far", F.abs("corr") > 0.75)
    assert [(r["column_a"], r["column_b"]) for r in pairs.where("far").collect()] == [("c3", "c700")]
    some = pairs.where("column_a IN ('c5', 'c64') AND column_b IN ('c64', 'c128', 'c999')").collect()
    assert len(some) == 5 and all(r["corr"] == pytest.approx(wanted[int(r["column_a"][1:]), int(r["column_b"][1:])]) for r in some)
    packed = profile._tile_moments(df, np.zeros(width))
    assert packed.count() == width * (width - 1) // 2


def test_correlation_of_no_columns(spark):
    assert O.column_correlations(spark.createDataFrame([("a",)], "t string")).collect() == []


def test_correlated_columns_list_the_later_one(df, frame):
    assert O.correlated_columns(df, 0.9, ["x", "copy", "plus", "minus", "gaps", "other"]) == ["copy", "plus", "minus", "gaps"]


def test_duplicates(df):
    assert O.duplicate_columns(df, ["k"]) == ["copy"]


def test_duplicate_check_is_exact_where_checksums_cancel(spark):
    rows = [(1, 5, 6)] * 2
    df = spark.createDataFrame(rows, "k int, a int, b int")
    assert O.duplicate_columns(df, ["k"]) == []
    assert O.duplicate_columns(spark.createDataFrame([(1, 5, 5)] * 2, "k int, a int, b int"), ["k"]) == ["b"]


def test_quasi_constant_counts_nulls_in_the_total(spark, df):
    assert O.quasi_constant_columns(df.drop("k"), 0.98) == ["flat", "nearly"]
    assert O.quasi_constant_columns(df.select("nearly", "mostly", "x"), 0.9) == ["nearly", "mostly"]
    assert O.quasi_constant_columns(df.select("nearly", "x"), 0.004) == ["nearly"]
    text = spark.createDataFrame([("a",)] * 97 + [(None,)] * 3, "s string")
    assert O.quasi_constant_columns(text, 0.98) == []
    assert O.quasi_constant_columns(text, 0.97) == ["s"]


def test_low_variance(df, frame):
    assert O.low_variance_columns(df, 0.12, ["x", "flat", "nearly", "mostly", "empty"]) == ["flat", "nearly"]


def test_outlier_cap_keeps_nulls(spark):
    rows = [(float(v),) for v in range(100)] + [(1e6,), (None,)]
    df = spark.createDataFrame(rows, "v double")
    values = pd.Series([r[0] for r in rows[:-1]])
    low, high = values.quantile(0.01), values.quantile(0.99)
    got = [r["v"] for r in O.cap_outliers(df, ["v"]).collect()]
    assert max(v for v in got if v is not None) == pytest.approx(high + 1.5 * (high - low))
    assert None in got


def test_narrow_types_have_strict_bounds(spark):
    df = spark.createDataFrame(
        [(127, 126, 32766, 2147483646, 2147483647, 1.5, "t", None)],
        "a long, b long, c long, d long, e long, f double, g string, h long",
    )
    types = dict(O.narrow_types(df).dtypes)
    assert types == {
        "a": "smallint", "b": "tinyint", "c": "smallint", "d": "int", "e": "bigint", "f": "float", "g": "string", "h": "bigint",
    }


def test_null_shares(df):
    row = O.null_shares(df.select("x", "empty")).first()
    assert (row["x"], row["empty"]) == (0.0, 1.0)
