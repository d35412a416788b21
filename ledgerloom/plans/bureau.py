"""External-credit recipes: monthly status to credit, credits to applicant."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    code_to_int,
    flag,
    is_member,
    not_equal_keep_null,
    null_below,
    regroup,
    round_even,
    safe_div,
    smoothed_ratio,
    xor_score,
)
from ..operators.aggregate import Shares, Subset, share_exprs, summarize
from ..operators.encode import Known, category_lists
from ..operators.project import fill_zero
from ..operators.ranking import average_rank
from ..sources import checkpoint
from . import fixed



def _status(name: str) -> Column:
    return F.col("CREDIT_ACTIVE") == name


def _with_monthly_shares(
    credits: DataFrame, months: DataFrame, statuses: Known = None
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Month span and status shares per credit, joined to the credits.

    Returns the frame and the spec that carries the shares on to the applicant.
    """
    per_credit = summarize(
        months,
        ["SK_ID_BUREAU"],
        {"MONTHS_BALANCE": ["min", "max", "size"]},
        shares=Shares(category_lists(months, statuses, ["STATUS"])),
    )
    carried = {c: ["mean"] for c in per_credit.columns if c.startswith("STATUS_")}
    return credits.join(per_credit, "SK_ID_BUREAU", "left"), carried


def bureau_base(
    credits: DataFrame,
    months: DataFrame,
    categories: Known = None,
    statuses: Known = None,
) -> DataFrame:
    """All, active and closed credits per applicant in one aggregation.

    Category lists that are known already save the passes that learn them.
    """
    df, carried = _with_monthly_shares(credits, months, statuses)
    return summarize(
        df,
        ["SK_ID_CURR"],
        fixed.BUREAU_BASE | carried,
        "BURO_",
        Shares(category_lists(credits, categories)),
        [
            Subset("BURO_NEW_ACTIVE_", _status("Active"), fixed.BUREAU_BASE),
            Subset("BURO_NEW_CLOSED_", _status("Closed"), fixed.BUREAU_BASE),
        ],
        deal=True,
        counted=credits,
        apart=True,
    )


def credit_status_score(months: DataFrame) -> DataFrame:
    """Status counts, shares and the severity score of each credit."""
    means = share_exprs(Shares({"STATUS": ["0", "C", "X"]}, ["mean"]))
    df = summarize(
        months,
        ["SK_ID_BUREAU"],
        {"MONTHS_BALANCE": ["count"]},
        shares=Shares({"STATUS": fixed.STATUS_CODES}, ["sum"]),
        extra=means,
    )
    levels = [f"STATUS_{level}_SUM" for level in range(1, 6)]
    return df.withColumn("NEW_STATUS_SCORE", xor_score(*levels)).drop(*levels)


def _regrouped(credits: DataFrame) -> DataFrame:
    return credits.withColumns(
        {
            "CREDIT_TYPE": regroup("CREDIT_TYPE", fixed.RARE_CREDIT_TYPES, "Rare"),
            "CREDIT_ACTIVE": regroup("CREDIT_ACTIVE", ["Bad debt", "Sold"], "Active"),
            "NEW_MONTHS_CREDIT": round_even((F.col("DAYS_CREDIT_ENDDATE") - F.col("DAYS_CREDIT")) / F.lit(30.0)),
        }
    )


def bureau_score(credits: DataFrame, months: DataFrame) -> DataFrame:
    """Regrouped credit types with status sums, ranges and active / closed subsets."""
    df = _regrouped(credits).join(credit_status_score(months), "SK_ID_BUREAU", "left")
    groups = {"CREDIT_ACTIVE": ["Active", "Closed"], "CREDIT_TYPE": ["Rare", "Consumer credit", "Credit card"]}
    out = summarize(
        df,
        ["SK_ID_CURR"],
        fixed.BUREAU_SCORE,
        "BB_",
        Shares(groups, ["sum", "mean"]),
        [
            Subset("BB_NEW_ACTIVE_", _status("Active"), fixed.BUREAU_SCORE_SUBSET),
            Subset("BB_NEW_CLOSED_", _status("Closed"), fixed.BUREAU_SCORE_SUBSET),
        ],
        deal=True,
        counted=credits,
        apart=True,
    )
    span = F.col("BB_DAYS_CREDIT_MAX") - F.col("BB_DAYS_CREDIT_MIN")
    return out.withColumns(
        {
            "BB_NEW_AMT_CREDIT_SUM_RANGE": F.col("BB_AMT_CREDIT_SUM_MAX") - F.col("BB_AMT_CREDIT_SUM_MIN"),
            "BB_NEW_DAYS_CREDIT_RANGE": round_even(safe_div(span, 30 * F.col("BB_SK_ID_CURR_COUNT"))),
        }
    )


def bureau_filled(credits: DataFrame, months: DataFrame, categories: Known = None, statuses: Known = None) -> DataFrame:
    """Zero-filled inputs, spread and median of the amounts, active / closed subsets."""
    credits, months = _regrouped(fill_zero(credits)), fill_zero(months)
    df, carried = _with_monthly_shares(credits, months, statuses)
    return summarize(
        df,
        ["SK_ID_CURR"],
        fixed.BUREAU_FILLED | carried,
        "BURO_",
        Shares(category_lists(credits, categories)),
        [
            Subset("BURO_ACT_", _status("Active"), fixed.BUREAU_FILLED),
            Subset("BURO_CLS_", _status("Closed"), fixed.BUREAU_FILLED),
        ],
        deal=True,
        counted=credits,
        apart=True,
    )


def bureau_behaviour(credits: DataFrame) -> DataFrame:
    """Counts of credit behaviour per applicant, and the rank of the worst delay."""
    df = fill_zero(credits)
    overdue, debt = F.col("AMT_CREDIT_MAX_OVERDUE"), F.col("AMT_CREDIT_SUM_DEBT")
    early = flag(_status("Active") & (F.col("DAYS_CREDIT_ENDDATE") < 0))
    counts = summarize(
        df,
        ["SK_ID_CURR"],
        {},
        extra={
            "BURO_CREDIT_APPLICATION_COUNT": F.count("SK_ID_BUREAU"),
            "BURO_ACTIVE_CREDIT_APPLICATION_COUNT": F.count_if(_status("Active")),
            "BURO_CLOSED_CREDIT_APPLICATION_COUNT": F.count_if(_status("Closed")),
            "BURO_EARLY_SHUTDOWN_NEW": F.max(early),
            "BURO_NUMBER_OF_DELAYED_PAYMENTS": F.count_if(overdue != 0),
            "BURO_MAX_TIME_PASSED_CREDIT_APPLICATION": F.coalesce(
                F.max(F.when(_status("Closed"), F.col("DAYS_ENDDATE_FACT"))), F.lit(0)
            ),
            "BURO_MAX_DELAYED_PAYMENTS": F.max(overdue),
            "BURO_IS_CREDIT_EXTENSION_NEW": flag(F.count("CNT_CREDIT_PROLONG") > 0),
            "BURO_CREDIT_EXTENSION_MAX": F.max("CNT_CREDIT_PROLONG"),
            "BURO_IS_UNSUCCESSFUL_CREDIT_PAYMENT_NEW": flag(F.count_if(_status("Closed") & (debt > 0)) > 0),
        },
    )
    # Ranking reads the counts several times.
    return average_rank(checkpoint(counts), "BURO_MAX_DELAYED_PAYMENTS", "BURO_DELAYED_PAYMENTS_TOP_100_NEW")


def bureau_filled_with_behaviour(
    credits: DataFrame, months: DataFrame, categories: Known = None, statuses: Known = None
) -> DataFrame:
    """Both zero-filled tables side by side."""
    filled = fill_zero(bureau_filled(credits, months, categories, statuses), keep=["SK_ID_CURR"])
    return filled.join(bureau_behaviour(credits), "SK_ID_CURR")


def bureau_skew(credits: DataFrame, months: DataFrame, on_zero: str = "null", categories: Known = None) -> DataFrame:
    """Delinquency level from the status code, its shape per credit, and type flags."""
    months = months.withColumns(
        {
            "NEW_BUREAU_BALANCE_DPD_LEVEL": code_to_int("STATUS", fixed.STATUS_ZERO_CODES),
            "NEW_BUREAU_BALANCE_STATUS_UNKNOW": flag(F.col("STATUS") == "X"),
            "MONTHS_BALANCE": 1 - F.col("MONTHS_BALANCE"),
        }
    )
    per_credit = summarize(months, ["SK_ID_BUREAU"], fixed.DELINQUENCY_PER_CREDIT)
    kind = F.col("CREDIT_TYPE")
    named = ["Consumer credit", "Car loan", "Mortgage", "Credit card"]
    df = credits.join(per_credit, "SK_ID_BUREAU", "left").withColumns(
        {
            "BUREAU_CREDIT_TYPE_CONSUMER": flag(kind == "Consumer credit"),
            "BUREAU_CREDIT_TYPE_CAR": flag(kind == "Car loan"),
            "BUREAU_CREDIT_TYPE_MORTGAGE": flag(kind == "Mortgage"),
            "BUREAU_CREDIT_TYPE_CREDIT_CARD": flag(kind == "Credit card"),
            "BUREAU_CREDIT_TYPE_OTHER": flag(~is_member(kind, named)),
            "BUREAU_UNUSUAL_CURRENCY": flag(not_equal_keep_null("CREDIT_CURRENCY", "currency 1")),
            "NEW_PAYMENT_RATE_SUM": safe_div("AMT_ANNUITY", "AMT_CREDIT_SUM", on_zero),
            "NEW_PAYMENT_RATE_SUM_DEBT": safe_div("AMT_ANNUITY", "AMT_CREDIT_SUM_DEBT", on_zero),
            "NEW_PAYMENT_RATE_AMT_CREDIT_MAX_OVERDUE": safe_div("AMT_ANNUITY", "AMT_CREDIT_MAX_OVERDUE", on_zero),
        }
    )
    return summarize(
        df,
        ["SK_ID_CURR"],
        fixed.BUREAU_SKEW,
        "BURO_",
        Shares(category_lists(credits, categories, ["CREDIT_ACTIVE"])),
        [Subset("ACTIVE_", _status("Active"), fixed.BUREAU_SKEW), Subset("CLOSED_", _status("Closed"), fixed.BUREAU_SKEW)],
        deal=True,
        counted=credits,
        apart=True,
    )


def bureau_ratios(
    credits: DataFrame, months: DataFrame, on_zero: str = "null", categories: Known = None, statuses: Known = None
) -> DataFrame:
    """Implausible dates removed, debt and overdue ratios, category shares and counts."""
    days = ["DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE"]
    df = credits.drop("CREDIT_CURRENCY").withColumns(
        {
            "CREDIT_TYPE": regroup("CREDIT_TYPE", fixed.MINOR_CREDIT_TYPES, "Rare"),
            **{c: null_below(c, fixed.EARLIEST_DAY) for c in days},
        }
    )
    df = df.withColumns(
        {
            "NEW_DAYS_CREDIT_UPDATE_DIFF": F.col("DAYS_CREDIT") - F.col("DAYS_CREDIT_UPDATE"),
            "NEW_EARLY_PAID": flag(F.col("DAYS_ENDDATE_FACT") <= F.col("DAYS_CREDIT_ENDDATE")).cast("double"),
            "NEW_OVERDUE_TO_CREDIT_SUM_RATIO": safe_div("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM", on_zero),
            "NEW_OVERDUE_TO_DEBT_SUM_RATIO": safe_div("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT", on_zero),
            "NEW_DEBT_SUM_TO_CREDIT_SUM_RATIO": safe_div("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", on_zero),
            "NEW_ANNUITY_TO_CREDIT_SUM_RATIO": safe_div("AMT_ANNUITY", "AMT_CREDIT_SUM", on_zero),
            "NEW_AMT_LIMIT_RATIO": smoothed_ratio("AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM"),
        }
    )
    lists = category_lists(df, categories)
    df, carried = _with_monthly_shares(df, months, statuses)
    return summarize(
        df, ["SK_ID_CURR"], fixed.BUREAU_RATIOS | carried, "BUREAU_", Shares(lists, ["mean", "sum"]), deal=True, counted=credits, apart=True
    )
