import math

import pytest

from ledgerloom import plans
from ledgerloom.catalog.standins import CreditTables


@pytest.fixture(scope="module")
def pos(spark):
    rows = [(10, 1, -1, 12.0, 0.0, 0, 0, "Active"), (10, 1, -2, 12.0, 3.0, 4, 1, None), (11, 2, -1, None, None, 0, 0, "Signed")]
    return spark.createDataFrame(
        rows,
        "SK_ID_PREV long, SK_ID_CURR long, MONTHS_BALANCE int, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double, "
        "SK_DPD int, SK_DPD_DEF int, NAME_CONTRACT_STATUS string",
    )


@pytest.fixture(scope="module")
def instalments(spark):
    rows = [
        (10, 1, 1.0, 1, -100.0, -90.0, 50.0, 50.0),
        (10, 1, 1.0, 2, -70.0, -75.0, 0.0, 20.0),
        (10, 1, 2.0, 3, -40.0, None, 60.0, None),
    ]
    return spark.createDataFrame(
        rows,
        "SK_ID_PREV long, SK_ID_CURR long, NUM_INSTALMENT_VERSION double, NUM_INSTALMENT_NUMBER int, DAYS_INSTALMENT double, "
        "DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double",
    )


def test_known_categories_replace_learning_and_absent_ones_give_zero(pos):
    learned = {r["SK_ID_CURR"]: r for r in plans.pos_base(pos).collect()}
    listed = plans.pos_base(pos, {"NAME_CONTRACT_STATUS": ["Active", "Demand", None]})
    for row in listed.collect():
        assert row["POS_NAME_CONTRACT_STATUS_Demand_MEAN"] == 0.0
        assert row["POS_NAME_CONTRACT_STATUS_nan_MEAN"] == learned[row["SK_ID_CURR"]]["POS_NAME_CONTRACT_STATUS_nan_MEAN"]
    assert learned[1]["POS_NAME_CONTRACT_STATUS_Active_MEAN"] == 0.5


def test_a_column_without_known_categories_is_named(pos):
    with pytest.raises(ValueError, match="no known categories for NAME_CONTRACT_STATUS"):
        plans.pos_flat(pos, {"OTHER": ["x"]})


def test_known_categories_start_no_job(spark, pos):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("known", "")
    plans.pos_flat(pos, {"NAME_CONTRACT_STATUS": ["Signed", "Active"]})
    known = len(tracker.getJobIdsForGroup("known"))
    spark.sparkContext.setJobGroup("learned", "")
    plans.pos_flat(pos)
    assert known == 0 < len(tracker.getJobIdsForGroup("learned"))


def test_missing_payment_rules(instalments):
    row = plans.instalment_base(instalments).first()
    assert (row["INSTAL_NEW_DPD_MAX"], row["INSTAL_NEW_DPD_SUM"]) == (10.0, 10.0)
    assert (row["INSTAL_NEW_DBD_MAX"], row["INSTAL_NEW_DBD_SUM"]) == (5.0, 5.0)
    assert row["INSTAL_NUM_INSTALMENT_VERSION_NUNIQUE"] == 2 and row["INSTAL_NEW_COUNT"] == 3
    assert row["INSTAL_NEW_PAYMENT_PERC_MAX"] == 1.0
    status = plans.instalment_status(instalments).first()
    shares = [status[f"NEW_INSTALMENT_PAYMENT_STATUS_{s}_MEAN"] for s in ("In Time", "Late", "No Payment")]
    assert shares == pytest.approx([0.0, 1 / 3, 1 / 3])
    assert status["NEW_INSTALMENT_PAYMENT_RATE_MIN"] == 0.0


def test_ieee_ratio_reaches_the_aggregate(instalments):
    row = plans.instalment_base(instalments, on_zero="ieee").first()
    assert row["INSTAL_NEW_PAYMENT_PERC_MAX"] == math.inf
    assert row["INSTAL_NEW_PAYMENT_PERC_VAR"] is None


def test_loan_that_ran_out_without_completion(pos):
    got = {r["SK_ID_PREV"]: r["POS_NEW_IS_CREDIT_NOT_COMPLETED_ON_TIME"] for r in plans.pos_per_loan(pos).collect()}
    assert got == {10: 1, 11: 0}


def test_score_uses_and_binds_tighter_than_xor(spark):
    statuses = ["1", "2", "2", "3", "5", "0", "C", None]
    months = spark.createDataFrame([(7, -i, s) for i, s in enumerate(statuses)], "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string")
    row = plans.credit_status_score(months).first()
    assert row["NEW_STATUS_SCORE"] == 1 + 2 ^ 2 + 1 ^ 3 + 0 ^ 4 + 1 ^ 5
    assert row["STATUS_0_MEAN"] == pytest.approx(1 / 8)


@pytest.mark.parametrize("recipe", ["base", "drop_first", "regrouped"])
def test_earlier_applications_go_to_their_applicants_before_the_wide_aggregate(spark, recipe):
    t = CreditTables(spark, "/root/testdata/sf0.001")
    earlier = t["previous_application"]
    if recipe == "regrouped":
        paid, pos = plans.instalments_per_loan(t["installments_payments"]), plans.pos_per_loan(t["POS_CASH_balance"])
        out = plans.previous_regrouped(earlier, paid, pos)
    else:
        out = {"base": plans.previous_base, "drop_first": plans.previous_drop_first}[recipe](earlier)
    assert "RepartitionByExpression [SK_ID_CURR" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == earlier.select("SK_ID_CURR").where("SK_ID_CURR IS NOT NULL").distinct().count()
