import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import operators as O

slow = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows share one value, and one group holds most rows."""
    rng = np.random.default_rng(7)
    v = np.where(rng.random(600) < 0.34, 5.0, rng.integers(0, 40, 600)).astype(float)
    return pd.DataFrame({"i": np.arange(600), "g": np.where(rng.random(600) < 0.7, "hot", "cold"), "v": v})


def test_average_rank_matches_pandas(spark, skewed):
    df = spark.createDataFrame(skewed)
    expected = skewed["v"].rank()
    for hot_rows in (10**9, 50, 1):
        got = O.average_rank(df, "v", "r", hot_rows).select("i", "r").toPandas().sort_values("i")
        assert np.allclose(got["r"].to_numpy(), expected.to_numpy())
    assert expected.sum() == 600 * 601 / 2


def test_rank_of_null_is_null(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0)], "i int, v double")
    assert {r["i"]: r["r"] for r in O.average_rank(df, "v", "r").collect()} == {1: 2.0, 2: None, 3: 1.0}


def test_group_quantiles_match_pandas(spark, skewed):
    df = spark.createDataFrame(skewed)
    got = O.group_quantiles(df, "v", {"q1": 0.01, "m": 0.5, "q9": 0.9}, ["g"]).toPandas().set_index("g")
    for name, q in {"q1": 0.01, "m": 0.5, "q9": 0.9}.items():
        assert np.allclose(got[name].sort_index(), skewed.groupby("g")["v"].quantile(q).sort_index())


@slow
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30), st.floats(0, 1))
def test_quantile_property(spark, values, q):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = O.group_quantiles(df, "v", {"q": q}).first()["q"]
    assert got == pytest.approx(pd.Series(values).quantile(q), rel=1e-9, abs=1e-6)


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores, strict=True) if y == 1]
    neg = [s for y, s in zip(labels, scores, strict=True) if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties_and_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(int(f), int(y), float(s)) for f, y, s in zip(rng.integers(0, 2, 200), rng.integers(0, 2, 200), rng.integers(0, 9, 200), strict=True)]
    df = spark.createDataFrame(rows, "fold int, y int, s double")
    auc = O.roc_auc(df, "y", "s").first()["auc"]
    assert auc == pytest.approx(brute_auc([r[1] for r in rows], [r[2] for r in rows]))
    flipped = O.roc_auc(df.withColumn("s", 1 - F.col("s")), "y", "s").first()["auc"]
    assert auc + flipped == pytest.approx(1.0)
    by_fold = {r["fold"]: r["auc"] for r in O.roc_auc(df, "y", "s", group_by=["fold"]).collect()}
    for fold in (0, 1):
        part = [r for r in rows if r[0] == fold]
        assert by_fold[fold] == pytest.approx(brute_auc([r[1] for r in part], [r[2] for r in part]))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert O.roc_auc(df, "y", "s").first()["auc"] is None


def test_lookup_join_keeps_every_row(spark):
    rows = [("hot", i) for i in range(50)] + [("cold", 1), ("cold", 2), (None, 3), ("absent", 4)]
    df = spark.createDataFrame(rows, "k string, i int")
    lookup = spark.createDataFrame([("hot", 50, 1.5), ("cold", 2, 2.5)], "k string, n int, x double")
    expected = sorted(((k, i, {"hot": 1.5, "cold": 2.5}.get(k)) for k, i in rows), key=str)
    for hot_rows in (1, 10, 1000):
        got = O.lookup_join(df, lookup, ["k"], "n", hot_rows).collect()
        assert sorted(map(tuple, got), key=str) == expected


def test_lookup_join_reads_the_rows_once_and_deals_hot_and_null_keys_out(spark, tmp_path):
    rows = [("hot" if i % 2 else None, i) for i in range(4000)] + [("cold", -1), ("a b", -2)]
    spark.createDataFrame(rows, "k string, `i.j` int").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    lookup = spark.createDataFrame([("hot", 2000, 1.5), ("cold", 1, 2.5)], "k string, n int, `x.y` double")
    joined = O.lookup_join(df, lookup, ["k"], "n", 100)
    assert joined.columns == ["k", "i.j", "x.y"] and joined.count() == 4002
    assert {(r[0], r[2]) for r in joined.collect()} == {("hot", 1.5), (None, None), ("cold", 2.5), ("a b", None)}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = joined.withColumn("p", F.spark_partition_id()).groupBy("k", "p").count().groupBy("k").agg(F.count("p").alias("parts")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r["k"]: r["parts"] > 1 for r in parts} == {"hot": True, None: True, "cold": False, "a b": False}


def test_group_stats_written_back(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    got = O.attach_group_stats(df, ["k"], [F.avg("v").alias("m")], hot_rows=2).collect()
    assert sorted(map(tuple, got)) == [("a", 1.0, 2.0), ("a", 3.0, 2.0), ("b", 5.0, 5.0)]


def test_row_positions_are_dense_per_group(spark, skewed):
    got = O.row_positions(spark.createDataFrame(skewed), ["i"], ["g"], "p").toPandas()
    for _, part in got.groupby("g"):
        assert sorted(part["p"]) == list(range(len(part)))
        assert part.sort_values("i")["p"].is_monotonic_increasing
