import pytest

from ledgerloom import operators as O
from ledgerloom.sources import jdbc_options, read_csv, read_snapshot, row_cap, sample_rows, write_csv, write_snapshot


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b/c` int, `d.e` int")
    assert O.clean_names(df).columns == ["abc", "de"]


@pytest.mark.parametrize("names", ["`a b` int, `ab` int", "`A+` int, `a` int"])
def test_clean_names_collide(spark, names):
    with pytest.raises(ValueError, match="would both become"):
        O.clean_names(spark.createDataFrame([(1, 2)], names))


def test_whole_frame_sentinels(spark):
    df = spark.createDataFrame([(365243, 365243.0, "XNA"), (1, 2.0, "y")], "k long, d double, s string")
    got = O.null_sentinel_everywhere(O.null_sentinel_everywhere(df, 365243, keep=["k"]), "XNA").collect()
    assert [tuple(r) for r in got] == [(365243, None, None), (1, 2.0, "y")]


def test_fill_zero_covers_text(spark):
    df = spark.createDataFrame([(None, None)], "d double, s string")
    assert tuple(O.fill_zero(df).first()) == (0.0, "0")


def test_suffixes_are_given_without_regard_to_case(spark):
    a = spark.createDataFrame([(1, "x")], "k int, A string")
    b = spark.createDataFrame([(1, "y")], "k int, a string")
    assert O.join_suffixed(a, b, ["k"]).columns == ["k", "A_x", "a_y"]


def test_suffixes_and_flags(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (1, "w")], "k int, v string")
    assert O.join_suffixed(a, b, ["k"]).columns == ["k", "v_x", "v_y"]
    assert sorted(map(tuple, O.exists_flag(a, b, ["k"], "f").collect())) == [(1, "x", 1), (2, "y", 0)]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, O.union_all_by_name(a, b).collect())) == [(1, 2), (3, None)]


def test_csv_roundtrip_and_key_first(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "s string, k int")
    write_csv(df, str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"), "s string, k int", key="k")
    assert back.columns == ["k", "s"]
    assert {r["s"]: r["k"] for r in back.collect()} == {"a": 1, "b": None}
    assert dict(read_csv(spark, str(tmp_path / "t")).dtypes) == {"s": "string", "k": "int"}


def test_snapshot_split_is_pruned(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0), (2, None)], "k int, y double")
    write_snapshot(df, str(tmp_path / "s"), label="y")
    score = read_snapshot(spark, str(tmp_path / "s"), "score")
    assert [tuple(r) for r in score.collect()] == [(2, None)]
    assert "PartitionFilters: [isnotnull(split" in score._jdf.queryExecution().executedPlan().toString()


def test_row_cap_and_sample_repeat(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    assert [r["k"] for r in row_cap(df, 3, ["k"]).collect()] == [0, 1, 2]
    assert row_cap(df, None, ["k"]).count() == 50
    first = {r["k"] for r in sample_rows(df, 10, ["k"]).collect()}
    again = {r["k"] for r in sample_rows(df.repartition(5), 10, ["k"]).collect()}
    assert first == again and len(first) == 10


def test_jdbc_options():
    plain = jdbc_options("jdbc:x:y", "t")
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000"}
    split = jdbc_options("jdbc:x:y", "t", "id", 1, 100, 8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x:y", "t", "id")
