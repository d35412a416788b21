"""Credit-schema tables derived from the shared test tables.

The recipes of ``ledgerloom.plans`` expect credit-data tables.  Each table here
is a row-for-row projection of a test table: applicants from customers, external
credits and earlier applications from orders, monthly balances and instalments
from order lines, card months from events.  The text is SQL that Spark and
DuckDB both run; only the day difference is spelled per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_APPLICANT = """
SELECT
  c_custkey AS SK_ID_CURR,
  {target}
  CASE WHEN c_acctbal > 9.9e3 THEN 'XNA' WHEN c_nationkey > 12 THEN 'F' ELSE 'M' END AS CODE_GENDER,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Y' ELSE 'N' END AS FLAG_OWN_REALTY,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 365243 WHEN c_acctbal < 0 THEN 0
       ELSE -CAST(floor(c_acctbal) AS INTEGER) END AS DAYS_EMPLOYED,
  -8000 - CAST(floor(c_acctbal * 15e-1) AS INTEGER) AS DAYS_BIRTH,
  2e4 + c_acctbal * 2e0 AS AMT_INCOME_TOTAL,
  CASE WHEN c_nationkey = 3 THEN 0e0 ELSE 5e4 + c_acctbal * 3e0 + c_nationkey * 1e3 END AS AMT_CREDIT,
  CASE WHEN c_nationkey <> 7 THEN 2e3 + c_acctbal END AS AMT_ANNUITY,
  CASE WHEN c_nationkey = 11 THEN 0e0 ELSE 45e3 + c_acctbal * 25e-1 END AS AMT_GOODS_PRICE,
  CASE WHEN c_nationkey = 20 THEN NULL WHEN c_nationkey > 20 THEN 0e0 WHEN c_nationkey > 14 THEN 5e0
       WHEN c_nationkey > 9 THEN 3e0 WHEN c_nationkey > 4 THEN 2e0 ELSE 1e0 END AS CNT_FAM_MEMBERS,
  CASE WHEN c_nationkey > 14 THEN 2 WHEN c_nationkey > 9 THEN 1 ELSE 0 END AS CNT_CHILDREN,
  CASE WHEN c_acctbal <= 5e3 THEN (c_acctbal + 1e3) / 12e3 END AS EXT_SOURCE_1,
  c_nationkey / 25e0 AS EXT_SOURCE_2,
  CASE WHEN c_mktsegment <> 'HOUSEHOLD' AND c_acctbal > 5e2 THEN c_acctbal / 1e4 END AS EXT_SOURCE_3,
  CASE WHEN c_nationkey < 5 THEN 0e0 WHEN c_nationkey = 13 THEN NULL ELSE -floor(c_acctbal) END AS DAYS_LAST_PHONE_CHANGE,
  CASE WHEN c_nationkey = 1 THEN NULL WHEN c_acctbal > 95e2 THEN 1e0 ELSE 0e0 END AS AMT_REQ_CREDIT_BUREAU_HOUR,
  CASE WHEN c_nationkey = 1 THEN NULL WHEN c_acctbal < -5e2 THEN 2e0 ELSE 0e0 END AS AMT_REQ_CREDIT_BUREAU_DAY,
  CASE WHEN c_nationkey = 1 THEN NULL WHEN c_nationkey = 2 THEN 1e0 ELSE 0e0 END AS AMT_REQ_CREDIT_BUREAU_WEEK,
  CASE WHEN c_nationkey = 1 THEN NULL WHEN c_nationkey IN (4, 5) THEN 1e0 ELSE 0e0 END AS AMT_REQ_CREDIT_BUREAU_MON,
  CASE WHEN c_nationkey = 1 THEN NULL WHEN c_nationkey IN (6, 8) THEN 1e0 ELSE 0e0 END AS AMT_REQ_CREDIT_BUREAU_QRT,
  CASE WHEN c_nationkey = 1 THEN NULL WHEN c_nationkey IN (6, 9, 10) THEN 3e0 ELSE 0e0 END AS AMT_REQ_CREDIT_BUREAU_YEAR,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Academic degree' WHEN 'MACHINERY' THEN 'Higher education'
       WHEN 'AUTOMOBILE' THEN 'Incomplete higher' WHEN 'HOUSEHOLD' THEN 'Lower secondary'
       ELSE 'Secondary / secondary special' END AS NAME_EDUCATION_TYPE,
  CASE WHEN c_nationkey = 12 THEN NULL WHEN c_acctbal < 0 THEN 'Yes' ELSE 'No' END AS EMERGENCYSTATE_MODE,
  r_name AS FONDKAPREMONT_MODE,
  n_name AS HOUSETYPE_MODE,
  CASE WHEN c_nationkey < 3 THEN 'Revolving loans' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
  c_mktsegment AS NAME_FAMILY_STATUS,
  CASE WHEN c_acctbal < -7e2 THEN 'Co-op apartment' WHEN c_acctbal < -4e2 THEN 'Office apartment'
       WHEN c_acctbal < 2e3 THEN 'Rented apartment' WHEN c_acctbal < 5e3 THEN 'With parents'
       WHEN c_acctbal < 6e3 THEN 'Municipal apartment' ELSE 'House / apartment' END AS NAME_HOUSING_TYPE,
  CASE WHEN c_acctbal < 3e3 THEN 'Working' WHEN c_acctbal < 6e3 THEN 'Commercial associate'
       WHEN c_acctbal < 9e3 THEN 'Pensioner' ELSE 'State servant' END AS NAME_INCOME_TYPE,
  CASE WHEN c_nationkey = 9 THEN NULL WHEN c_acctbal < 5e3 THEN 'Unaccompanied' ELSE 'Spouse, partner' END AS NAME_TYPE_SUITE,
  CASE WHEN c_nationkey > 20 THEN NULL ELSE c_mktsegment END AS OCCUPATION_TYPE,
  CASE WHEN c_nationkey < 12 THEN 'Business Entity Type 3' ELSE n_name END AS ORGANIZATION_TYPE,
  CASE WHEN c_nationkey < 10 THEN 'Stone, brick' WHEN c_nationkey < 20 THEN 'Panel' END AS WALLSMATERIAL_MODE,
  CASE r_name WHEN 'ASIA' THEN 'MONDAY' WHEN 'EUROPE' THEN 'SUNDAY' ELSE 'FRIDAY' END AS WEEKDAY_APPR_PROCESS_START
FROM {{customer}}
JOIN {{nation}} ON n_nationkey = c_nationkey
JOIN {{region}} ON r_regionkey = n_regionkey
WHERE {split}
"""

_TABLES = {
    "application_train": _APPLICANT.format(
        target="CASE WHEN c_acctbal < 2e3 THEN 1e0 ELSE 0e0 END AS TARGET,", split="c_mktsegment <> 'BUILDING'"
    ),
    "application_test": _APPLICANT.format(target="", split="c_mktsegment = 'BUILDING'"),
    "bureau": """
SELECT
  o_custkey AS SK_ID_CURR,
  o_orderkey AS SK_ID_BUREAU,
  CASE WHEN o_orderstatus = 'F' THEN 'Closed' WHEN o_orderstatus = 'O' THEN 'Active'
       WHEN o_orderpriority = '1-URGENT' THEN 'Bad debt' ELSE 'Sold' END AS CREDIT_ACTIVE,
  CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 4e5 THEN 'currency 2' ELSE 'currency 1' END AS CREDIT_CURRENCY,
  CASE WHEN o_totalprice < 1e4 THEN NULL WHEN o_totalprice < 2e5 THEN 'Consumer credit'
       WHEN o_totalprice < 3e5 THEN 'Credit card' WHEN o_totalprice < 35e4 THEN 'Car loan'
       WHEN o_totalprice < 4e5 THEN 'Mortgage' ELSE 'Microloan' END AS CREDIT_TYPE,
  {days:o_orderdate} AS DAYS_CREDIT,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_totalprice > 48e4 THEN -25e3
       ELSE {days:o_orderdate} + floor(o_totalprice / 1e2) END AS DAYS_CREDIT_ENDDATE,
  CASE WHEN o_orderstatus = 'F' THEN {days:o_orderdate} + floor(o_totalprice / 15e1) + 0e0 END AS DAYS_ENDDATE_FACT,
  {days:o_orderdate} + floor(o_totalprice / 1e3) + 0e0 AS DAYS_CREDIT_UPDATE,
  CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(floor(o_totalprice / 1e4) AS INTEGER) ELSE 0 END AS CREDIT_DAY_OVERDUE,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN floor(o_totalprice / 1e2)
       ELSE 0e0 END AS AMT_CREDIT_MAX_OVERDUE,
  CASE WHEN o_totalprice > 3e5 AND o_orderpriority = '3-MEDIUM' THEN 2 WHEN o_totalprice < 5e4 THEN 1 ELSE 0 END AS CNT_CREDIT_PROLONG,
  CASE WHEN o_totalprice > 47e4 THEN 0e0 ELSE o_totalprice / 1e2 END AS AMT_CREDIT_SUM,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' AND o_totalprice < 4e5 THEN 0e0
       ELSE o_totalprice / 2e2 END AS AMT_CREDIT_SUM_DEBT,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice / 1e3 END AS AMT_CREDIT_SUM_LIMIT,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 1e4 ELSE 0e0 END AS AMT_CREDIT_SUM_OVERDUE,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 12e2 END AS AMT_ANNUITY
FROM {orders}
""",
    "bureau_balance": """
SELECT
  l_orderkey AS SK_ID_BUREAU,
  -l_linenumber AS MONTHS_BALANCE,
  CASE WHEN l_tax = 0e0 THEN NULL WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'C'
       WHEN l_returnflag = 'R' THEN 'X' WHEN l_quantity < 25e0 THEN '0' WHEN l_quantity < 35e0 THEN '1'
       WHEN l_quantity < 42e0 THEN '2' WHEN l_quantity < 46e0 THEN '3' WHEN l_quantity < 49e0 THEN '4' ELSE '5' END AS STATUS
FROM {lineitem}
""",
    "previous_application": """
SELECT
  o_orderkey AS SK_ID_PREV,
  o_custkey AS SK_ID_CURR,
  CASE WHEN o_totalprice > 48e4 THEN 'Unused offer' WHEN o_orderstatus = 'F' THEN 'Approved'
       WHEN o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice / 1e3 END AS AMT_ANNUITY,
  o_totalprice / 5e1 AS AMT_APPLICATION,
  CASE WHEN o_totalprice < 2e4 THEN 0e0 ELSE floor(o_totalprice / 45e2) * 1e2 END AS AMT_CREDIT,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 5e2 END AS AMT_DOWN_PAYMENT,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / (CASE WHEN o_orderstatus = 'O' THEN 45e0 WHEN o_orderstatus = 'F' THEN 5e1 ELSE 4e1 END) END AS AMT_GOODS_PRICE,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 1e6 END AS RATE_DOWN_PAYMENT,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice / 3e6 END AS RATE_INTEREST_PRIMARY,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice / 6e5 END AS RATE_INTEREST_PRIVILEGED,
  CAST(floor(o_totalprice / 21e3) AS INTEGER) AS HOUR_APPR_PROCESS_START,
  CASE WHEN o_totalprice < 1e5 THEN 'MONDAY' WHEN o_totalprice < 2e5 THEN 'WEDNESDAY' WHEN o_totalprice < 3e5 THEN 'SATURDAY'
       WHEN o_totalprice < 4e5 THEN 'SUNDAY' ELSE 'FRIDAY' END AS WEEKDAY_APPR_PROCESS_START,
  CAST(floor({days:o_orderdate} / 2e0) AS INTEGER) AS DAYS_DECISION,
  CASE WHEN o_orderstatus = 'F' THEN {days:o_orderdate} + 3e1 ELSE 365243e0 END AS DAYS_FIRST_DRAWING,
  CASE WHEN o_orderstatus = 'P' THEN 365243e0 ELSE {days:o_orderdate} + 6e1 END AS DAYS_FIRST_DUE,
  CASE WHEN o_orderpriority = '5-LOW' THEN 365243e0 ELSE {days:o_orderdate} + floor(o_totalprice / 1e3) END AS DAYS_LAST_DUE_1ST_VERSION,
  CASE WHEN o_totalprice < 4e3 THEN NULL WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 365243e0 WHEN o_totalprice < 25e4 THEN {days:o_orderdate} + floor(o_totalprice / 1e3)
       ELSE {days:o_orderdate} + 25e1 END AS DAYS_LAST_DUE,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 365243e0 ELSE {days:o_orderdate} + 27e1 END AS DAYS_TERMINATION,
  CASE WHEN o_totalprice > 45e4 THEN 0e0 WHEN o_orderpriority <> '2-HIGH' THEN floor(o_totalprice / 1e4) END AS CNT_PAYMENT,
  CAST(floor(o_totalprice / 1e3) AS INTEGER) AS SELLERPLACE_AREA,
  CASE WHEN o_totalprice < 4e4 THEN 0 ELSE 1 END AS NFLAG_LAST_APPL_IN_DAY,
  CASE WHEN o_orderstatus = 'F' THEN 1e0 WHEN o_orderstatus = 'O' THEN 0e0 END AS NFLAG_INSURED_ON_APPROVAL,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Consumer loans' WHEN o_orderpriority = '2-HIGH' THEN 'Revolving loans'
       WHEN o_totalprice < 3e3 THEN 'XNA' ELSE 'Cash loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN o_totalprice < 2e5 THEN 'XAP' WHEN o_totalprice < 3e5 THEN 'XNA' WHEN o_totalprice < 4e5 THEN 'Repairs'
       WHEN o_totalprice < 45e4 THEN 'Urgent needs' WHEN o_totalprice < 495e3 THEN 'Buying a holiday home / land' ELSE 'Hobby' END AS NAME_CASH_LOAN_PURPOSE,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'XNA' WHEN o_totalprice > 49e4 THEN 'Non-cash from your account'
       ELSE 'Cash through the bank' END AS NAME_PAYMENT_TYPE,
  CASE WHEN o_orderstatus <> 'O' THEN 'XAP' WHEN o_orderpriority = '1-URGENT' THEN 'HC' WHEN o_orderpriority = '2-HIGH' THEN 'LIMIT'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'SCO' WHEN o_totalprice < 3e4 THEN 'SYSTEM' ELSE 'CLIENT' END AS CODE_REJECT_REASON,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL WHEN o_totalprice < 25e4 THEN 'Unaccompanied' WHEN o_totalprice < 4e5 THEN 'Family'
       ELSE 'Spouse, partner' END AS NAME_TYPE_SUITE,
  CASE WHEN o_totalprice < 5e3 THEN 'XNA' WHEN o_totalprice < 1e5 THEN 'New' WHEN o_totalprice < 2e5 THEN 'Refreshed' ELSE 'Repeater' END AS NAME_CLIENT_TYPE,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Mobile' WHEN o_totalprice < 5e4 THEN 'Audio/Video' WHEN o_totalprice < 6e4 THEN 'Jewelry'
       WHEN o_totalprice < 62e3 THEN 'Animals' WHEN o_totalprice < 2e5 THEN 'XNA' ELSE 'Photo / Cinema Equipment' END AS NAME_GOODS_CATEGORY,
  CASE WHEN o_orderstatus = 'F' THEN 'POS' WHEN o_orderstatus = 'O' THEN 'Cash' WHEN o_totalprice < 1e5 THEN 'Cars' ELSE 'XNA' END AS NAME_PORTFOLIO,
  CASE WHEN o_totalprice < 25e4 THEN 'XNA' WHEN o_totalprice < 4e5 THEN 'x-sell' ELSE 'walk-in' END AS NAME_PRODUCT_TYPE,
  CASE WHEN o_totalprice < 2e4 THEN 'AP+ (Cash loan)' WHEN o_totalprice < 1e5 THEN 'Car dealer' WHEN o_totalprice < 2e5 THEN 'Stone'
       WHEN o_totalprice < 3e5 THEN 'Regional / Local' ELSE 'Country-wide' END AS CHANNEL_TYPE,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Consumer electronics' WHEN o_orderpriority = '2-HIGH' THEN 'XNA'
       WHEN o_totalprice < 8e3 THEN 'Tourism' ELSE 'Connectivity' END AS NAME_SELLER_INDUSTRY,
  CASE WHEN o_orderstatus = 'F' THEN 'middle' WHEN o_orderstatus = 'O' THEN 'low_normal' WHEN o_totalprice < 6e3 THEN 'low_action' ELSE 'XNA' END AS NAME_YIELD_GROUP,
  CASE WHEN o_totalprice < 3e3 THEN NULL WHEN o_totalprice < 9e3 THEN 'Card X-Sell' WHEN o_totalprice < 25e4 THEN 'Cash'
       ELSE 'POS mobile with interest' END AS PRODUCT_COMBINATION,
  CASE WHEN o_totalprice < 15e3 THEN 'N' ELSE 'Y' END AS FLAG_LAST_APPL_PER_CONTRACT
FROM {orders}
""",
    "POS_CASH_balance": """
SELECT
  l_orderkey AS SK_ID_PREV,
  o_custkey AS SK_ID_CURR,
  -l_linenumber AS MONTHS_BALANCE,
  CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS CNT_INSTALMENT,
  CASE WHEN l_returnflag <> 'N' THEN floor(l_quantity * l_discount * 1e1) + 0e0 END AS CNT_INSTALMENT_FUTURE,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS SK_DPD,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS SK_DPD_DEF,
  CASE WHEN l_quantity > 49e0 THEN NULL WHEN l_quantity > 48e0 THEN 'Demand' WHEN l_quantity > 47e0 THEN 'Returned to the store'
       WHEN l_quantity > 46e0 THEN 'XNA' WHEN l_linestatus = 'F' THEN 'Completed' WHEN l_returnflag = 'A' THEN 'Signed'
       ELSE 'Active' END AS NAME_CONTRACT_STATUS
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
""",
    "installments_payments": """
SELECT
  l_orderkey AS SK_ID_PREV,
  o_custkey AS SK_ID_CURR,
  CASE WHEN l_quantity < 5e0 THEN 4e0 WHEN l_quantity < 1e1 THEN 3e0 WHEN l_quantity < 2e1 THEN 2e0
       WHEN l_quantity < 45e0 THEN 1e0 ELSE 0e0 END AS NUM_INSTALMENT_VERSION,
  l_linenumber AS NUM_INSTALMENT_NUMBER,
  CAST({days:o_orderdate} AS DOUBLE) AS DAYS_INSTALMENT,
  CASE WHEN l_returnflag <> 'N' OR l_quantity < 4e1 THEN {days:o_orderdate} + floor(l_quantity - 25e0) + 0e0 END AS DAYS_ENTRY_PAYMENT,
  CASE WHEN l_quantity > 49e0 THEN 0e0 ELSE l_extendedprice / 1e2 END AS AMT_INSTALMENT,
  CASE WHEN l_returnflag <> 'N' OR l_quantity < 4e1 THEN l_extendedprice * (1e0 - l_discount) / 1e2 END AS AMT_PAYMENT
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
""",
    "credit_card_balance": """
SELECT
  user_id * 10 + length(event_type) AS SK_ID_PREV,
  user_id AS SK_ID_CURR,
  {days:ts} AS MONTHS_BALANCE,
  value AS AMT_BALANCE,
  CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN event_type = 'error' THEN -1e0 WHEN event_type = 'purchase' THEN value / 4e0 END AS AMT_DRAWINGS_ATM_CURRENT,
  CASE WHEN event_type = 'error' THEN -2e0 WHEN event_type = 'view' THEN 0e0 ELSE value / 2e0 END AS AMT_DRAWINGS_CURRENT,
  CASE WHEN event_type = 'click' THEN value / 8e0 END AS AMT_DRAWINGS_OTHER_CURRENT,
  CASE WHEN event_type <> 'view' THEN value / 3e0 END AS AMT_DRAWINGS_POS_CURRENT,
  CASE WHEN event_type <> 'signup' THEN value / 1e1 END AS AMT_INST_MIN_REGULARITY,
  CASE WHEN event_type <> 'click' THEN floor(value) / 1e1 + (CASE WHEN event_type = 'view' THEN 1e0 ELSE 0e0 END) END AS AMT_PAYMENT_CURRENT,
  value / 5e0 AS AMT_PAYMENT_TOTAL_CURRENT,
  value * 9e-1 AS AMT_RECEIVABLE_PRINCIPAL,
  value * 11e-1 AS AMT_RECIVABLE,
  value * 12e-1 AS AMT_TOTAL_RECEIVABLE,
  CASE WHEN event_type = 'purchase' THEN floor(value / 2e1) + 0e0 END AS CNT_DRAWINGS_ATM_CURRENT,
  CAST(floor(value / 1e1) AS INTEGER) AS CNT_DRAWINGS_CURRENT,
  CASE WHEN event_type = 'click' THEN 1e0 END AS CNT_DRAWINGS_OTHER_CURRENT,
  CASE WHEN event_type <> 'view' THEN floor(value / 3e1) + 0e0 END AS CNT_DRAWINGS_POS_CURRENT,
  CASE WHEN event_type <> 'error' THEN floor(value / 5e0) + 0e0 END AS CNT_INSTALMENT_MATURE_CUM,
  CASE WHEN event_type = 'error' THEN CAST(floor(value) AS INTEGER) ELSE 0 END AS SK_DPD,
  CASE WHEN event_type = 'error' AND value > 5e1 THEN 1 ELSE 0 END AS SK_DPD_DEF,
  CASE event_type WHEN 'click' THEN 'Active' WHEN 'view' THEN 'Active' WHEN 'purchase' THEN 'Completed'
       WHEN 'signup' THEN 'Signed' ELSE 'Demand' END AS NAME_CONTRACT_STATUS
FROM {events}
""",
}

_DAY_ZERO = "2002-01-01"
_SPARK_DAYS = f"datediff(CAST({{}} AS DATE), DATE '{_DAY_ZERO}')"
_DUCKDB_DAYS = f"CAST(date_diff('day', DATE '{_DAY_ZERO}', CAST({{}} AS DATE)) AS INTEGER)"


def _render(text: str, days: str, table) -> str:
    for column in ("o_orderdate", "ts"):
        text = text.replace("{days:" + column + "}", days.format(column))
    for name in TEST_TABLES:
        text = text.replace("{" + name + "}", table(name))
    return text


def table_sql(name: str) -> str:
    """DuckDB text of one credit-schema table."""
    return _render(_TABLES[name], _DUCKDB_DAYS, lambda n: n)


def with_tables(*names: str) -> str:
    """``WITH`` clause defining credit-schema tables for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({table_sql(n)})" for n in names)


class CreditTables(dict):
    """Credit-schema DataFrames, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        text = _TABLES[name]
        used = {n: load(self._spark, self._sf_dir, n) for n in TEST_TABLES if "{" + n + "}" in text}
        self[name] = self._spark.sql(_render(text, _SPARK_DAYS, lambda n: "{" + n + "}"), **used)
        return self[name]
