"""Loan-balance and instalment recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clip_zero, flag, overwrite, regroup, safe_div
from ..operators.aggregate import Shares, Spec, summarize
from ..operators.encode import Known, category_lists
from ..sources import checkpoint, free_files
from . import fixed


def pos_base(months: DataFrame, categories: Known = None) -> DataFrame:
    """One level, with status shares."""
    return summarize(
        months,
        ["SK_ID_CURR"],
        fixed.POS_BASE,
        "POS_",
        Shares(category_lists(months, categories)),
        extra={"POS_NEW_COUNT": F.count(F.lit(1))},
    )


def pos_flat(months: DataFrame, categories: Known = None) -> DataFrame:
    """One level, with the shares of all statuses but the first."""
    lists = category_lists(months, categories, null_column=False, drop_first=True)
    return summarize(months, ["SK_ID_CURR"], fixed.POS_FLAT, "", Shares(lists))


def pos_per_loan(months: DataFrame) -> DataFrame:
    """Per loan, with a flag for loans whose instalments ran out without completion."""
    statuses = Shares({"NAME_CONTRACT_STATUS": fixed.POS_PER_LOAN_STATUSES}, ["sum"])
    out = summarize(months, ["SK_ID_PREV"], fixed.POS_PER_LOAN, "POS_", statuses)
    late = (F.col("POS_CNT_INSTALMENT_FUTURE_MIN") == 0) & (F.col("POS_NAME_CONTRACT_STATUS_Completed_SUM") == 0)
    return out.withColumn("POS_NEW_IS_CREDIT_NOT_COMPLETED_ON_TIME", flag(late))


def _per_applicant(loans: DataFrame, spec: Spec, prefix: str, rows: DataFrame) -> DataFrame:
    """The second level; an applicant has no more loans than ``rows``."""
    counted = rows.select(F.col("SK_ID_CURR").alias("SK_ID_CURR_MAX"))
    out = summarize(loans, ["SK_ID_CURR_MAX"], spec, prefix, deal=True, counted=counted)
    return out.withColumnRenamed("SK_ID_CURR_MAX", "SK_ID_CURR")


def pos_two_level(months: DataFrame) -> DataFrame:
    """Per loan, then per applicant."""
    df = months.withColumns(
        {
            "NEW_ADJOURNMENT": F.col("SK_DPD") - F.col("SK_DPD_DEF"),
            "NAME_CONTRACT_STATUS": regroup("NAME_CONTRACT_STATUS", fixed.MINOR_POS_STATUSES, "Others"),
        }
    )
    statuses = Shares({"NAME_CONTRACT_STATUS": fixed.POS_LEVEL_ONE_STATUSES}, ["sum"])
    loans = summarize(df, ["SK_ID_PREV"], fixed.POS_LEVEL_ONE, shares=statuses)
    loans = loans.withColumn("NEW_PAID_MONTH", F.col("CNT_INSTALMENT_MAX") - F.col("CNT_INSTALMENT_FUTURE_MIN"))
    return _per_applicant(loans, fixed.POS_LEVEL_TWO, "POS_", months)


def instalment_base(instalments: DataFrame, on_zero: str = "null") -> DataFrame:
    """Paid share and difference, days past due and days before due."""
    late = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    df = instalments.withColumns(
        {
            "NEW_PAYMENT_PERC": safe_div("AMT_PAYMENT", "AMT_INSTALMENT", on_zero),
            "NEW_PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
            "NEW_DPD": clip_zero(late),
            "NEW_DBD": clip_zero(-late),
        }
    )
    return summarize(
        df,
        ["SK_ID_CURR"],
        fixed.INSTALMENT_BASE,
        "INSTAL_",
        extra={"INSTAL_NEW_COUNT": F.count(F.lit(1))},
        deal=True,
        counted=instalments,
    )


def instalments_per_loan(instalments: DataFrame, on_zero: str = "null") -> DataFrame:
    """Per loan, with the paid share and what is left to pay."""
    early = F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT")
    df = instalments.withColumns({"NEW_DAYS_PAID_EARLIER": early, "NEW_NUM_PAID_LATER": flag(early < 0)})
    return summarize(df, ["SK_ID_PREV"], fixed.INSTALMENT_PER_LOAN, "INS_").withColumns(
        {
            "INS_NEW_PAYMENT_PERC": safe_div("INS_AMT_PAYMENT_SUM", "INS_AMT_INSTALMENT_SUM", on_zero),
            "INS_NEW_PAYMENT_DIFF": F.col("INS_AMT_INSTALMENT_SUM") - F.col("INS_AMT_PAYMENT_SUM"),
        }
    )


def instalments_two_level(instalments: DataFrame) -> DataFrame:
    """Per loan, then per applicant."""
    df = instalments.withColumns(
        {
            "NEW_DELAY": F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT"),
            "NEW_PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        }
    )
    versions = Shares({"NUM_INSTALMENT_VERSION": fixed.INSTALMENT_VERSIONS}, ["sum"])
    loans = summarize(df, ["SK_ID_PREV"], fixed.INSTALMENT_LEVEL_ONE, shares=versions).withColumns(
        {
            "NEW_DAYS_INSTALMENT_NUMBER": F.col("DAYS_INSTALMENT_MAX") - F.col("DAYS_INSTALMENT_MIN"),
            "NEW_AMT_INSTALMENT_DIFF": F.col("AMT_INSTALMENT_MAX") - F.col("AMT_INSTALMENT_MIN"),
        }
    )
    return _per_applicant(loans, fixed.INSTALMENT_LEVEL_TWO, "INSTAL_", instalments)


def instalment_status(instalments: DataFrame, on_zero: str = "null") -> DataFrame:
    """Paid share with missing payments as 0, and payment-status shares."""
    early, in_time, late, unpaid = fixed.INSTALMENT_STATUS_LABELS
    days = F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT")
    df = instalments.na.fill({"AMT_PAYMENT": 0.0}).withColumns(
        {
            "NEW_INSTALMENT_PAYMENT_STATUS": overwrite(
                F.lit(unpaid), [(days == 0, in_time), (days > 0, early), (days < 0, late)]
            ),
            "NEW_INS_IS_LATE": flag(days < 0),
        }
    )
    df = df.withColumn("NEW_INSTALMENT_PAYMENT_RATE", safe_div("AMT_PAYMENT", "AMT_INSTALMENT", on_zero) * 100)
    shares = Shares({"NEW_INSTALMENT_PAYMENT_STATUS": [in_time, late, unpaid]})
    return summarize(df, ["SK_ID_CURR"], fixed.INSTALMENT_STATUS, "", shares)


def instalments_with_pos(instalments: DataFrame, months: DataFrame, settle: bool = False) -> DataFrame:
    """Applicants that have both instalments and loan balances.

    ``settle`` settles the balances first, so that the shuffles of both are not on disk at once.
    """
    balances = pos_flat(months)
    if settle:
        balances = checkpoint(balances)
        free_files(balances.sparkSession)
    return instalment_status(instalments).join(balances, "SK_ID_CURR")
