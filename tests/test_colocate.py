import glob
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom import operators as O
from ledgerloom import plans
from ledgerloom.catalog import basics, learning
from ledgerloom.catalog.standins import CreditTables
from ledgerloom.operators import colocate
from ledgerloom.operators.encode import learn_values
from ledgerloom.sources import drop_scratch, scratch_path, write_snapshot
from ledgerloom.sources.shared import shared_folder


def plan(df):
    df.collect()  # the adaptive plan is final after a run
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def frames(spark):
    parent = spark.createDataFrame([(i if i else None, f"p{i}") for i in range(50)], "k int, p string")
    rows = spark.createDataFrame([(i % 30, float(i)) for i in range(300)], "k int, v double")
    one = rows.groupBy("k").agg(F.sum("v").alias("s"))
    two = rows.where("k > 3").groupBy("k").agg(F.count("v").alias("n"))
    return parent, one, two


def test_bucketed_star_equals_joins_and_has_no_exchange(frames):
    parent, one, two = frames
    got = O.star("k", lambda: parent, lambda: one, lambda: two, buckets=3)
    assert "Exchange" not in plan(got)
    plain = parent.join(one, "k", "left").join(two, "k", "left")
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
    assert sorted(O.star("k", lambda: parent, lambda: one, lambda: two).collect(), key=str) == sorted(plain.collect(), key=str)


def test_bucketed_tables_keep_rows_empty_tables_and_odd_names(spark, frames):
    parent, *_ = frames
    odd = parent.select("k", F.col("p").alias("a.b, c/d (e)"))
    assert sorted(O.bucketed(odd, "k", 4).collect(), key=str) == sorted(odd.collect(), key=str)
    empty = O.bucketed(parent.where("k < 0"), "k", 4)
    assert empty.columns == parent.columns and empty.count() == 0


def shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_bucketed_star_stores_and_lets_go_of_a_table_before_the_next_is_planned(spark, frames, monkeypatch):
    parent, one, two = frames
    steps, left, before = [], [], shuffles(spark)
    store = colocate.bucketed
    monkeypatch.setattr(colocate, "bucketed", lambda df, *a, **k: steps.append(("stored", df.columns[-1])) or store(df, *a, **k))

    def planned(df):
        until = time.time() + 20  # Spark's cleaner works in a thread of its own
        while shuffles(spark) - before and time.time() < until:
            time.sleep(0.1)
        left.append(shuffles(spark) - before)
        steps.append(("planned", df.columns[-1]))
        return df

    O.star("k", *[lambda df=df: planned(df) for df in frames], buckets=3)
    assert steps == [(what, c) for c in ("p", "s", "n") for what in ("planned", "stored")]
    assert left == [set()] * 3


def test_bucketed_tables_are_dropped_with_their_files(spark, frames):
    parent, one, two = frames
    kept = O.bucketed(two, "k", 3)
    wide = O.star("k", lambda: parent, lambda: one, buckets=3)
    files = [f.removeprefix("file:") for f in wide.inputFiles()]
    tables = {t.name for t in spark.catalog.listTables()}
    O.drop_bucketed(wide)
    assert files and not any(glob.glob(f) for f in files)
    assert len(tables - {t.name for t in spark.catalog.listTables()}) == 2
    assert sorted(kept.collect()) == sorted(two.collect())


def test_only_scratch_is_dropped(spark, frames):
    path = scratch_path(spark, "some")
    write_snapshot(frames[0], path)
    with pytest.raises(ValueError, match="not a scratch path"):
        drop_scratch(spark, path + "/part")
    assert glob.glob(path.removeprefix("file:"))
    drop_scratch(spark, path)
    assert not glob.glob(path.removeprefix("file:"))


def small_wide(spark, asked):
    rows = spark.range(80).selectExpr(
        "id AS SK_ID_CURR", "CASE WHEN id % 5 > 0 THEN CAST(id % 2 AS DOUBLE) END AS TARGET", "CAST(id % 7 AS DOUBLE) AS a", "id % 2 + id % 3 AS b"
    )
    more = rows.groupBy("SK_ID_CURR").agg(F.max("b").alias("c"), F.sum(F.col("a") * F.col("a")).alias("d"))

    def wide_rare(t, categories=None, buckets=None):
        asked.append(buckets)
        return O.star("SK_ID_CURR", lambda: rows, lambda: more, buckets=buckets)

    return wide_rare


def left_over(spark, label):
    return glob.glob(f"{shared_folder(spark).removeprefix('file:')}/scratch/{label}-*")


def test_wide_snapshot_is_made_of_stored_tables_and_leaves_none(spark, sf_dir, monkeypatch):
    asked, tables, folders = [], spark.catalog.listTables(), left_over(spark, "bucketed")
    monkeypatch.setattr(plans, "wide_rare", small_wide(spark, asked))
    got = basics.pipe_prune(spark, sf_dir)
    assert got.columns == ["SK_ID_CURR", "TARGET", "a", "b"] and got.count() == 80
    assert asked == [4]
    assert spark.catalog.listTables() == tables and left_over(spark, "bucketed") == folders


def test_training_keeps_the_pruned_table_only(spark, sf_dir, monkeypatch):
    wide, pruned = left_over(spark, "wide"), left_over(spark, "pruned")
    monkeypatch.setattr(plans, "wide_rare", small_wide(spark, []))
    scored = learning.pipe_train(spark, sf_dir)
    assert left_over(spark, "wide") == wide and len(left_over(spark, "pruned")) == len(pruned) + 1
    assert sorted(r["SK_ID_CURR"] for r in scored.collect()) == list(range(0, 80, 5))


def test_filling_leaves_the_key_as_the_rows_are_dealt(spark, frames):
    _, one, two = frames
    odd = one.join(two, "k", "left").withColumnRenamed("n", "a.b")
    assert sorted(O.fill_zero(odd, keep=["k"]).collect()) == sorted(O.fill_zero(odd).collect())
    assert O.fill_zero(spark.createDataFrame([(None, None)], "k int, v int"), keep=["k"]).collect() == [(None, 0)]
    bare, filled = one.join(two.hint("merge"), "k"), O.fill_zero(one, keep=["k"]).join(two.hint("merge"), "k")
    assert plan(filled).count("Exchange") == plan(bare).count("Exchange")


def test_filled_credits_are_not_moved_again(spark, sf_dir):
    t = CreditTables(spark, sf_dir)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = plans.bureau_filled(t["bureau"], t["bureau_balance"])
        both = plans.bureau_filled_with_behaviour(t["bureau"], t["bureau_balance"])
        behaviour = plans.bureau_behaviour(t["bureau"])
        exchanges = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (filled, behaviour, both)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    # One more, for the behaviour, which is joined on another column before.
    assert exchanges[2] <= exchanges[0] + exchanges[1] + 1


def test_settled_balances_give_the_same_rows(spark, sf_dir):
    t = CreditTables(spark, sf_dir)
    both = t["installments_payments"], t["POS_CASH_balance"]
    plain, settled = (plans.instalments_with_pos(*both, settle=s) for s in (False, True))
    assert settled.columns == plain.columns
    assert settled.exceptAll(plain).isEmpty() and plain.count() == settled.count()


def test_wide_table_joins_without_exchange(spark, sf_dir):
    wide = plans.wide_base(CreditTables(spark, sf_dir), buckets=4)
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 5 and "Exchange" not in text


def test_failure_in_one_branch_is_raised(frames):
    def broken():
        raise ValueError("no such table")

    with pytest.raises(ValueError, match="no such table"):
        O.together(lambda: frames[0], broken)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(3, "b", "x", None), (1, "a", "y", "u"), (2, "b", None, "v"), (4, None, "z", "u")]
    return spark.createDataFrame(rows, "i int, two string, three string, half string")


def test_values_are_learned_in_code_order(people):
    columns = ["two", "three", "half"]
    assert learn_values(people, columns) == {"two": ["a", "b", None], "three": ["x", "y", "z", None], "half": ["u", "v", None]}
    assert learn_values(people, columns, F.col("i"))["three"] == ["y", "x", "z", None]
    assert learn_values(people, columns, limit=3) == {"two": ["a", "b", None], "half": ["u", "v", None]}
    assert learn_values(people, []) == {} and learn_values(people.limit(0), ["two"]) == {"two": []}


def test_values_are_learned_without_sorting_the_rows(spark, sf_dir, monkeypatch):
    from ledgerloom.operators import encode
    from ledgerloom.plans import applicants

    t = CreditTables(spark, sf_dir)
    df = applicants.known_gender(t["application_train"], t["application_test"])
    plans_seen = []
    settle = encode.checkpoint
    monkeypatch.setattr(type(df), "collect", lambda self, c=type(df).collect: plans_seen.append(self._jdf.queryExecution().sparkPlan().toString()) or c(self))
    monkeypatch.setattr(encode, "checkpoint", lambda frame: plans_seen.append(frame._jdf.queryExecution().sparkPlan().toString()) or settle(frame))
    columns = O.text_columns(df)[:3]
    for order in (None, applicants._appearance()):
        learn_values(df, columns, order)
    O.label_encode(df, columns)
    O.first_seen_encode(df, columns, applicants._appearance())
    encode.label_codes(df, columns[0])
    assert len(plans_seen) >= 5 and not [p for p in plans_seen if "SortAggregate" in p]


def test_appearance_orders_like_label_and_id(spark):
    from ledgerloom.plans import applicants

    rows = [(None, 1), (2**63 - 1, 1), (-(2**63), 1), (5, None), (None, None), (-(2**63), None), (5, 0), (-7, 1)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, TARGET int")
    want = df.orderBy(F.col("TARGET").isNull(), F.col("SK_ID_CURR")).collect()
    assert [tuple(r) for r in df.orderBy(applicants._appearance()).collect()] == [tuple(r) for r in want]


def test_known_values_give_the_codes_that_learning_gives(people):
    columns = ["two", "three", "half"]
    order = F.col("i")
    assert O.label_encode(people, columns).collect() == O.label_encode(people, columns, learn_values(people, columns)).collect()
    seen = O.first_seen_encode(people, columns, order, learn_values(people, columns, order))
    assert O.first_seen_encode(people, columns, order).collect() == seen.collect()
    two, names = O.label_encode_binary(people.drop("three"))
    known, known_names = O.label_encode_binary(people.drop("three"), learn_values(people, ["two", "half"]))
    assert names == known_names and two.collect() == known.collect()


def test_rare_labels_of_known_values(people):
    got = O.rare_labels(people, ["three", "half"], known={"three": ["x", "Rare"], "half": ["u", "v"]})
    assert [(r["three"], r["half"]) for r in got.orderBy("i").collect()] == [("Rare", "u"), (None, "v"), ("x", None), ("Rare", "u")]


def test_applicant_recipes_learn_in_one_pass_and_not_at_all_from_known_values(spark, sf_dir, monkeypatch):
    from ledgerloom.plans import applicants

    t = CreditTables(spark, sf_dir)
    both = t["application_train"], t["application_test"]
    passes = []
    learn = applicants.learn_values
    monkeypatch.setattr(applicants, "learn_values", lambda *a, **k: passes.append(1) or learn(*a, **k))
    for recipe in (applicants.applicant_base, applicants.applicant_label_nulls):
        passes.clear()
        first = recipe(*both)
        assert len(passes) == 1
        known = learn(applicants.known_gender(*both), O.text_columns(both[0]), F.struct(F.col("TARGET").isNull(), F.col("SK_ID_CURR")))
        spark.sparkContext.setJobGroup("known", "known values")
        again = recipe(*both, categories=known)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("known")
        spark.sparkContext._jsc.clearJobGroup()
        assert first.columns == again.columns
