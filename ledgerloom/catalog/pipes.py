"""Table recipes over the credit-schema stand-ins, each with oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import plans
from ..plans import fixed
from .sqltext import (
    Block,
    agg_list,
    dummy_list,
    grouped,
    items,
    left_joined,
    literal,
    quoted,
    ratio,
    settle,
    share_list,
)
from .standins import CreditTables, table_sql

Query = Callable[[SparkSession, str], DataFrame]


def _tables(*names: str) -> dict[str, str]:
    return {n: table_sql(n) for n in names}


def _in(values) -> str:
    return "(" + ", ".join(literal(v) for v in values) + ")"


# ---- values the stand-in tables hold -----------------------------------------

_NATIONS = sorted(f"NATION_{i}" for i in range(25))
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_HOUSING = [
    "Co-op apartment",
    "House / apartment",
    "Municipal apartment",
    "Office apartment",
    "Rented apartment",
    "With parents",
]
_APPLICANT_VALUES = {
    "NAME_EDUCATION_TYPE": [
        "Academic degree",
        "Higher education",
        "Incomplete higher",
        "Lower secondary",
        "Secondary / secondary special",
    ],
    "EMERGENCYSTATE_MODE": ["No", "Yes"],
    "FONDKAPREMONT_MODE": _REGIONS,
    "HOUSETYPE_MODE": _NATIONS,
    "NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"],
    "NAME_FAMILY_STATUS": _SEGMENTS,
    "NAME_HOUSING_TYPE": _HOUSING,
    "NAME_INCOME_TYPE": ["Commercial associate", "Pensioner", "State servant", "Working"],
    "NAME_TYPE_SUITE": ["Spouse, partner", "Unaccompanied"],
    "OCCUPATION_TYPE": _SEGMENTS,
    "ORGANIZATION_TYPE": ["Business Entity Type 3", *sorted(f"NATION_{i}" for i in range(12, 25))],
    "WALLSMATERIAL_MODE": ["Panel", "Stone, brick"],
    "WEEKDAY_APPR_PROCESS_START": ["FRIDAY", "MONDAY", "SUNDAY"],
}
_CREDIT_VALUES = {
    "CREDIT_ACTIVE": ["Active", "Bad debt", "Closed", "Sold"],
    "CREDIT_CURRENCY": ["currency 1", "currency 2"],
    "CREDIT_TYPE": ["Car loan", "Consumer credit", "Credit card", "Microloan", "Mortgage"],
}
_PREVIOUS_VALUES = {
    "NAME_CONTRACT_STATUS": ["Approved", "Canceled", "Refused", "Unused offer"],
    "WEEKDAY_APPR_PROCESS_START": ["FRIDAY", "MONDAY", "SATURDAY", "SUNDAY", "WEDNESDAY"],
    "NAME_CONTRACT_TYPE": ["Cash loans", "Consumer loans", "Revolving loans", "XNA"],
    "NAME_CASH_LOAN_PURPOSE": ["Buying a holiday home / land", "Hobby", "Repairs", "Urgent needs", "XAP", "XNA"],
    "NAME_PAYMENT_TYPE": ["Cash through the bank", "Non-cash from your account", "XNA"],
    "CODE_REJECT_REASON": ["CLIENT", "HC", "LIMIT", "SCO", "SYSTEM", "XAP"],
    "NAME_TYPE_SUITE": ["Family", "Spouse, partner", "Unaccompanied"],
    "NAME_CLIENT_TYPE": ["New", "Refreshed", "Repeater", "XNA"],
    "NAME_GOODS_CATEGORY": ["Animals", "Audio/Video", "Jewelry", "Mobile", "Photo / Cinema Equipment", "XNA"],
    "NAME_PORTFOLIO": ["Cars", "Cash", "POS", "XNA"],
    "NAME_PRODUCT_TYPE": ["XNA", "walk-in", "x-sell"],
    "CHANNEL_TYPE": ["AP+ (Cash loan)", "Car dealer", "Country-wide", "Regional / Local", "Stone"],
    "NAME_SELLER_INDUSTRY": ["Connectivity", "Consumer electronics", "Tourism", "XNA"],
    "NAME_YIELD_GROUP": ["XNA", "low_action", "low_normal", "middle"],
    "PRODUCT_COMBINATION": ["Card X-Sell", "Cash", "POS mobile with interest"],
    "FLAG_LAST_APPL_PER_CONTRACT": ["N", "Y"],
}
_POS_STATUSES = ["Active", "Completed", "Demand", "Returned to the store", "Signed", "XNA"]
_CARD_STATUSES = ["Active", "Completed", "Demand", "Signed"]


def _with_null(values: dict) -> dict:
    return {c: [*v, None] for c, v in values.items()}


# ---- applicants --------------------------------------------------------------

_APPLICANT_NUMBERS = (
    "DAYS_EMPLOYED DAYS_BIRTH AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY AMT_GOODS_PRICE CNT_FAM_MEMBERS CNT_CHILDREN "
    "EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3 DAYS_LAST_PHONE_CHANGE AMT_REQ_CREDIT_BUREAU_HOUR "
    "AMT_REQ_CREDIT_BUREAU_DAY AMT_REQ_CREDIT_BUREAU_WEEK AMT_REQ_CREDIT_BUREAU_MON AMT_REQ_CREDIT_BUREAU_QRT "
    "AMT_REQ_CREDIT_BUREAU_YEAR"
).split()

_BOTH = {
    **_tables("application_train", "application_test"),
    "everyone": "SELECT * FROM application_train UNION ALL BY NAME SELECT * FROM application_test",
    "known": "SELECT *, nullif(DAYS_EMPLOYED, 365243) AS employed FROM everyone WHERE CODE_GENDER IS DISTINCT FROM 'XNA'",
}
_EMPLOYED = {c: ("employed" if c == "DAYS_EMPLOYED" else c) for c in _APPLICANT_NUMBERS}
_BASE_RATIOS = {
    "NEW_DAYS_EMPLOYED_PERC": ratio("employed", "DAYS_BIRTH"),
    "NEW_INCOME_CREDIT_PERC": ratio("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "NEW_INCOME_PER_PERSON": ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "NEW_ANNUITY_INCOME_PERC": ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "NEW_PAYMENT_RATE": ratio("AMT_ANNUITY", "AMT_CREDIT"),
}


def _prefixed(exprs: dict[str, str], prefix: str = "APP_") -> dict[str, str]:
    return {prefix + n: e for n, e in exprs.items()}


def applicant_base_block() -> Block:
    codes = {}
    for c in fixed.BINARY_COLUMNS:
        codes[c] = f"CASE WHEN {c} IS NULL THEN -1 ELSE (SELECT code FROM code_{c} WHERE v = {c}) END"
    ctes = dict(_BOTH)
    ctes["placed"] = (
        "SELECT *, row_number() OVER (ORDER BY CASE WHEN TARGET IS NULL THEN 1 ELSE 0 END, SK_ID_CURR) AS place FROM known"
    )
    for c in fixed.BINARY_COLUMNS:
        ctes[f"code_{c}"] = (
            f"SELECT v, row_number() OVER (ORDER BY first) - 1 AS code FROM "
            f"(SELECT {c} AS v, min(place) AS first FROM placed WHERE {c} IS NOT NULL GROUP BY {c})"
        )
    exprs = _prefixed({**codes, **_EMPLOYED, **dummy_list(_APPLICANT_VALUES), **_BASE_RATIOS})
    ctes["applicant"] = f"SELECT SK_ID_CURR, TARGET, {items(exprs)} FROM known"
    return Block("applicant", ctes, ["TARGET", *exprs])


def _alphabetical(c: str, values: list[str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {literal(v)} THEN {i}" for i, v in enumerate(values)) + " END"


_BINARY_CODES = {
    "CODE_GENDER": _alphabetical("CODE_GENDER", ["F", "M"]),
    "FLAG_OWN_CAR": _alphabetical("FLAG_OWN_CAR", ["N", "Y"]),
    "FLAG_OWN_REALTY": _alphabetical("FLAG_OWN_REALTY", ["N", "Y"]),
}


def applicant_nulls_block() -> Block:
    exprs = _prefixed({**_BINARY_CODES, **_EMPLOYED, **dummy_list(_with_null(_APPLICANT_VALUES)), **_BASE_RATIOS})
    ctes = {**_BOTH, "applicant": f"SELECT SK_ID_CURR, TARGET, {items(exprs)} FROM known"}
    return Block("applicant", ctes, ["TARGET", *exprs])


def applicant_age_block() -> Block:
    age, worked = "(DAYS_BIRTH / -365.25e0)", "(employed / -365.25e0)"
    bins = (
        f"CASE WHEN {age} > 20 AND {age} <= 30 THEN 'Young' WHEN {age} > 30 AND {age} <= 40 THEN 'Adult 1' "
        f"WHEN {age} > 40 AND {age} <= 50 THEN 'Adult 2' WHEN {age} > 50 AND {age} <= 60 THEN 'Adult 3' "
        f"WHEN {age} > 60 THEN 'Adult 4' END"
    )
    scores = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    total = " + ".join(f"coalesce({s}, 0)" for s in scores)
    present = " + ".join(f"(CASE WHEN {s} IS NULL THEN 0 ELSE 1 END)" for s in scores)
    # Two values and no null: coded in place.  FLAG_OWN_REALTY has a null too, so it is one-hot.
    coded = {
        "CODE_GENDER": _BINARY_CODES["CODE_GENDER"],
        "FLAG_OWN_CAR": _BINARY_CODES["FLAG_OWN_CAR"],
        "NAME_CONTRACT_TYPE": _alphabetical("NAME_CONTRACT_TYPE", ["Cash loans", "Revolving loans"]),
    }
    hot = {c: v for c, v in _APPLICANT_VALUES.items() if c not in coded}
    hot |= {"FLAG_OWN_REALTY": ["N", "Y"], "APP_NEW_AGE_CAT": ["Adult 1", "Adult 2", "Adult 3", "Adult 4", "Young"]}
    exprs = {
        **coded,
        **_EMPLOYED,
        "APP_NEW_AGE": age,
        "APP_NEW_AGE_DAYS_EMP": worked,
        "APP_NEW_AGE_WORK_PERCENT": ratio(worked, age) + " * 100",
        "APP_NEW_CREDIT_INCOME_PERCENT": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "APP_NEW_ANNUITY_INCOME_PERCENT": ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "APP_NEW_DAYS_EMPLOYED_PERCENT": ratio("employed", "DAYS_BIRTH"),
        "APP_NEW_INCOME_PER_PERSON": ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "APP_NEW_INCOME_CREDIT_PERC": ratio("AMT_INCOME_TOTAL", "AMT_CREDIT"),
        "APP_NEW_PAYMENT_RATE": ratio("AMT_ANNUITY", "AMT_CREDIT"),
        "APP_NEW_AMT_PAY_YEAR": ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "APP_NEW_AGE_PAYOFF": age + " + " + ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "APP_NEW_AMT_DIFF_CREDIT_GOODS": "AMT_CREDIT - AMT_GOODS_PRICE",
        "APP_NEW_AMT_CREDIT_GOODS_PERC": ratio("AMT_GOODS_PRICE", "AMT_CREDIT") + " * 100",
        "APP_NEW_CNT_ADULT": "CNT_FAM_MEMBERS - CNT_CHILDREN",
        "APP_NEW_EXT_SOURCES_MEAN": ratio(f"({total})", f"({present})"),
        **dummy_list(_with_null(hot)),
    }
    ctes = {
        **_BOTH,
        "aged": f"SELECT *, {bins} AS APP_NEW_AGE_CAT FROM known",
        "applicant": f"SELECT SK_ID_CURR, TARGET, {items(exprs)} FROM aged",
    }
    return Block("applicant", ctes, ["TARGET", *exprs])


# Categories of the nominal columns left after rare ones are merged at sf0.01,
# without the first of each column.
_RARE_LEFT = {
    "EMERGENCYSTATE_MODE": ["Yes"],
    "FONDKAPREMONT_MODE": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "HOUSETYPE_MODE": [],
    "NAME_CONTRACT_TYPE": ["Revolving loans"],
    "NAME_FAMILY_STATUS": _SEGMENTS[1:],
    "NAME_HOUSING_TYPE": ["Municipal apartment", "Rare", "Rented apartment", "With parents"],
    "NAME_INCOME_TYPE": ["Pensioner", "State servant", "Working"],
    "NAME_TYPE_SUITE": ["Unaccompanied"],
    "OCCUPATION_TYPE": _SEGMENTS[1:],
    "ORGANIZATION_TYPE": ["Rare"],
    "WALLSMATERIAL_MODE": ["Stone, brick"],
    "WEEKDAY_APPR_PROCESS_START": ["MONDAY", "SUNDAY"],
}


def applicant_rare_block() -> Block:
    ctes = {k: v for k, v in _BOTH.items() if k != "known"}
    ctes["known"] = (
        "SELECT *, nullif(DAYS_EMPLOYED, 365243) AS employed, "
        "CASE WHEN CNT_FAM_MEMBERS > 3 THEN 4 ELSE CNT_FAM_MEMBERS END AS fam "
        "FROM everyone WHERE CODE_GENDER IS DISTINCT FROM 'XNA'"
    )
    merged = []
    for c in fixed.NOMINAL_COLUMNS:
        frequent = f"(SELECT {c} FROM known WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 0.05 * (SELECT count(*) FROM known))"
        many = f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM known)) > 4"
        merged.append(f"CASE WHEN {c} IS NULL OR NOT ({many}) OR {c} IN {frequent} THEN {c} ELSE 'Rare' END AS {c}")
    ctes["merged"] = f"SELECT * REPLACE ({', '.join(merged)}) FROM known"
    hour, day, week, month, quarter, year = (
        f"AMT_REQ_CREDIT_BUREAU_{u}" for u in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")
    )
    clear = f"{hour} = 0 AND {day} = 0"
    month_clear = f"{clear} AND {week} = 0 AND {month} = 0"
    recency = (
        f"coalesce(CASE WHEN {month_clear} AND {year} > 0 THEN 2 WHEN {month_clear} AND {quarter} > 0 THEN 2 "
        f"WHEN {clear} AND {month} > 0 THEN 1 WHEN {clear} AND {week} > 0 THEN 1 WHEN {day} > 0 THEN 1 "
        f"WHEN {hour} > 0 THEN 1 ELSE {week} END, 0)"
    )
    goods = ratio("AMT_CREDIT", "AMT_GOODS_PRICE")
    numbers = {**_EMPLOYED, "CNT_FAM_MEMBERS": "fam", "DAYS_BIRTH": "DAYS_BIRTH / 365.0e0"}
    education = _alphabetical("NAME_EDUCATION_TYPE", _APPLICANT_VALUES["NAME_EDUCATION_TYPE"])
    exprs = _prefixed(
        {
            **_BINARY_CODES,
            "NAME_EDUCATION_TYPE": f"CASE WHEN ({education}) = 1 THEN 0 ELSE ({education}) END",
            **numbers,
            **dummy_list(_RARE_LEFT),
            "NEW_GOODSPRICE/CREDIT": ratio("AMT_GOODS_PRICE", "AMT_CREDIT"),
            "NEW_ANNUITY/CREDIT": ratio("AMT_ANNUITY", "AMT_CREDIT"),
            "NEW_INCOME/ANNUITY": ratio("AMT_INCOME_TOTAL", "AMT_ANNUITY"),
            "NEW_DAYS_LAST_PHONE_CHANGE": "CASE WHEN DAYS_LAST_PHONE_CHANGE = 0 THEN 1 ELSE 0 END",
            "NEW_DAYS_BIRTH": "CASE WHEN DAYS_BIRTH / -365.0e0 <= 41 THEN 1 WHEN DAYS_BIRTH / -365.0e0 > 41 THEN 0 END",
            "NEW_CREDIT/INCOME": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
            "NEW_WORK/NOTWORK": "CASE WHEN DAYS_EMPLOYED = 0 THEN 0 ELSE 1 END",
            "NEW_INCOME/CREDIT": ratio("AMT_INCOME_TOTAL", "AMT_CREDIT"),
            "NEW_REQ": recency,
            "NEW_DAYS_EMPLOYED_PERC": ratio("employed", "DAYS_BIRTH"),
            "NEW_INCOME_PER_PERSON": ratio("AMT_INCOME_TOTAL", "fam"),
            **{f"NEW_EXT_RESOURCE_{i}_CREDIT_TO_GOODS_RATIO": ratio(f"EXT_SOURCE_{i}", goods) for i in (3, 2, 1)},
        }
    )
    ctes["applicant"] = f"SELECT SK_ID_CURR, TARGET, {items(exprs)} FROM merged"
    return Block("applicant", ctes, ["TARGET", *exprs])


# ---- external credits --------------------------------------------------------

_STATUS_ALL = {"STATUS": [*fixed.STATUS_CODES, None]}


def _month_block(statuses: dict, source: str = "bureau_balance", ctes: dict | None = None) -> Block:
    exprs = {
        **agg_list({"MONTHS_BALANCE": ["min", "max", "size"]}),
        **share_list(statuses),
    }
    return grouped("per_credit", source, "SK_ID_BUREAU", exprs, ctes or _tables("bureau_balance"))


def _credits_joined(per_credit: Block, source: str, ctes: dict, name: str = "credits") -> dict[str, str]:
    return {**per_credit.ctes, **ctes, name: f"SELECT * FROM {source} LEFT JOIN {per_credit.name} USING (SK_ID_BUREAU)"}


def bureau_base_block() -> Block:
    months = _month_block(_STATUS_ALL)
    carried = {c: ["mean"] for c in months.columns if c.startswith("STATUS_")}
    exprs = {
        **agg_list(fixed.BUREAU_BASE | carried, "BURO_"),
        **share_list(_with_null(_CREDIT_VALUES), prefix="BURO_"),
        **agg_list(fixed.BUREAU_BASE, "BURO_NEW_ACTIVE_", "CREDIT_ACTIVE = 'Active'"),
        **agg_list(fixed.BUREAU_BASE, "BURO_NEW_CLOSED_", "CREDIT_ACTIVE = 'Closed'"),
    }
    return grouped("buro", "credits", "SK_ID_CURR", exprs, _credits_joined(months, "bureau", _tables("bureau")))


def _xor(*terms: str) -> str:
    out = terms[0]
    for t in terms[1:]:
        out = f"xor({out}, {t})"
    return out


def status_score_block() -> Block:
    sums = {f"s{i}": f"CAST(count(*) FILTER (WHERE STATUS = '{i}') AS BIGINT)" for i in range(1, 6)}
    exprs = {
        "MONTHS_BALANCE_COUNT": "count(MONTHS_BALANCE)",
        **share_list({"STATUS": ["0", "C", "X"]}, ["sum", "mean"]),
        "NEW_STATUS_SCORE": _xor(
            f"{sums['s1']} + {sums['s2']}", f"2 + {sums['s3']}", f"3 + {sums['s4']}", f"4 + {sums['s5']}", "5"
        ),
    }
    return grouped("per_credit", "bureau_balance", "SK_ID_BUREAU", exprs, _tables("bureau_balance"))


def _regrouped_credits(source: str) -> str:
    return (
        f"SELECT * REPLACE (CASE WHEN CREDIT_TYPE IN {_in(fixed.RARE_CREDIT_TYPES)} THEN 'Rare' ELSE CREDIT_TYPE END AS CREDIT_TYPE, "
        f"CASE WHEN CREDIT_ACTIVE IN ('Bad debt', 'Sold') THEN 'Active' ELSE CREDIT_ACTIVE END AS CREDIT_ACTIVE), "
        f"round_even((DAYS_CREDIT_ENDDATE - DAYS_CREDIT) / 30.0e0, 0) AS NEW_MONTHS_CREDIT FROM {source}"
    )


def bureau_score_block() -> Block:
    months = status_score_block()
    ctes = _credits_joined(months, "regrouped", {**_tables("bureau"), "regrouped": _regrouped_credits("bureau")})
    groups = {"CREDIT_ACTIVE": ["Active", "Closed"], "CREDIT_TYPE": ["Rare", "Consumer credit", "Credit card"]}
    exprs = {
        **agg_list(fixed.BUREAU_SCORE, "BB_"),
        **share_list(groups, ["sum", "mean"], "BB_"),
        **agg_list(fixed.BUREAU_SCORE_SUBSET, "BB_NEW_ACTIVE_", "CREDIT_ACTIVE = 'Active'"),
        **agg_list(fixed.BUREAU_SCORE_SUBSET, "BB_NEW_CLOSED_", "CREDIT_ACTIVE = 'Closed'"),
        "BB_NEW_AMT_CREDIT_SUM_RANGE": "max(AMT_CREDIT_SUM) - min(AMT_CREDIT_SUM)",
        "BB_NEW_DAYS_CREDIT_RANGE": "round_even((max(DAYS_CREDIT) - min(DAYS_CREDIT)) / (30.0e0 * count(SK_ID_CURR)), 0)",
    }
    return grouped("bureau_scored", "credits", "SK_ID_CURR", exprs, ctes)


def _zero_filled(table: str, texts: list[str], numbers: list[str]) -> str:
    filled = [f"coalesce({c}, '0') AS {c}" for c in texts] + [f"coalesce({c}, 0) AS {c}" for c in numbers]
    return f"SELECT * REPLACE ({', '.join(filled)}) FROM {table}"


_CREDIT_NUMBERS = (
    "DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT AMT_CREDIT_MAX_OVERDUE AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_LIMIT AMT_ANNUITY"
).split()


def bureau_filled_block() -> Block:
    month_ctes = {
        **_tables("bureau_balance"),
        "months_filled": _zero_filled("bureau_balance", ["STATUS"], []),
    }
    months = _month_block({"STATUS": [*fixed.STATUS_CODES, None]}, "months_filled", month_ctes)
    ctes = _credits_joined(
        months,
        "filled_regrouped",
        {
            **_tables("bureau"),
            "bureau_filled": _zero_filled("bureau", ["CREDIT_TYPE"], _CREDIT_NUMBERS),
            "filled_regrouped": _regrouped_credits("bureau_filled"),
        },
        "filled_credits",
    )
    carried = {c: ["mean"] for c in months.columns if c.startswith("STATUS_")}
    values = {
        "CREDIT_ACTIVE": ["Active", "Closed", None],
        "CREDIT_CURRENCY": ["currency 1", "currency 2", None],
        "CREDIT_TYPE": ["0", "Consumer credit", "Credit card", "Rare", None],
    }
    exprs = {
        **agg_list(fixed.BUREAU_FILLED | carried, "BURO_"),
        **share_list(values, prefix="BURO_"),
        **agg_list(fixed.BUREAU_FILLED, "BURO_ACT_", "CREDIT_ACTIVE = 'Active'"),
        **agg_list(fixed.BUREAU_FILLED, "BURO_CLS_", "CREDIT_ACTIVE = 'Closed'"),
    }
    return grouped("buro", "filled_credits", "SK_ID_CURR", exprs, ctes)


def bureau_behaviour_block() -> Block:
    exprs = {
        "BURO_CREDIT_APPLICATION_COUNT": "count(SK_ID_BUREAU)",
        "BURO_ACTIVE_CREDIT_APPLICATION_COUNT": "count(*) FILTER (WHERE CREDIT_ACTIVE = 'Active')",
        "BURO_CLOSED_CREDIT_APPLICATION_COUNT": "count(*) FILTER (WHERE CREDIT_ACTIVE = 'Closed')",
        "BURO_EARLY_SHUTDOWN_NEW": "max(CASE WHEN CREDIT_ACTIVE = 'Active' AND DAYS_CREDIT_ENDDATE < 0 THEN 1 ELSE 0 END)",
        "BURO_NUMBER_OF_DELAYED_PAYMENTS": "count(*) FILTER (WHERE AMT_CREDIT_MAX_OVERDUE <> 0)",
        "BURO_MAX_TIME_PASSED_CREDIT_APPLICATION": "coalesce(max(DAYS_ENDDATE_FACT) FILTER (WHERE CREDIT_ACTIVE = 'Closed'), 0)",
        "BURO_MAX_DELAYED_PAYMENTS": "max(AMT_CREDIT_MAX_OVERDUE)",
        "BURO_IS_CREDIT_EXTENSION_NEW": "CASE WHEN count(CNT_CREDIT_PROLONG) > 0 THEN 1 ELSE 0 END",
        "BURO_CREDIT_EXTENSION_MAX": "max(CNT_CREDIT_PROLONG)",
        "BURO_IS_UNSUCCESSFUL_CREDIT_PAYMENT_NEW": (
            "CASE WHEN count(*) FILTER (WHERE CREDIT_ACTIVE = 'Closed' AND AMT_CREDIT_SUM_DEBT > 0) > 0 THEN 1 ELSE 0 END"
        ),
    }
    ctes = {**_tables("bureau"), "bureau_filled": _zero_filled("bureau", ["CREDIT_TYPE"], _CREDIT_NUMBERS)}
    counts = grouped("behaviour_counts", "bureau_filled", "SK_ID_CURR", exprs, ctes)
    rank = (
        "rank() OVER (ORDER BY BURO_MAX_DELAYED_PAYMENTS) + "
        "(count(*) OVER (PARTITION BY BURO_MAX_DELAYED_PAYMENTS) - 1) / 2.0e0"
    )
    text = f"SELECT *, {rank} AS BURO_DELAYED_PAYMENTS_TOP_100_NEW FROM behaviour_counts"
    return Block("behaviour", {**counts.ctes, "behaviour": text}, [*exprs, "BURO_DELAYED_PAYMENTS_TOP_100_NEW"])


def filled_with_behaviour_block() -> Block:
    filled, behaviour = bureau_filled_block(), bureau_behaviour_block()
    zeroed = ", ".join(f"coalesce(buro.{quoted(c)}, 0) AS {quoted(c)}" for c in filled.columns)
    rest = ", ".join(f"behaviour.{quoted(c)}" for c in behaviour.columns)
    text = f"SELECT SK_ID_CURR, {zeroed}, {rest} FROM buro JOIN behaviour USING (SK_ID_CURR)"
    ctes = {**filled.ctes, **behaviour.ctes, "buro_all": text}
    return Block("buro_all", ctes, [*filled.columns, *behaviour.columns])


def bureau_skew_block() -> Block:
    ctes = {
        **_tables("bureau_balance"),
        "levels": (
            "SELECT SK_ID_BUREAU, 1 - MONTHS_BALANCE AS MONTHS_BALANCE, CASE WHEN STATUS IN ('X', 'C') THEN 0 "
            "ELSE TRY_CAST(STATUS AS INTEGER) END AS NEW_BUREAU_BALANCE_DPD_LEVEL, "
            "CASE WHEN STATUS = 'X' THEN 1 ELSE 0 END AS NEW_BUREAU_BALANCE_STATUS_UNKNOW FROM bureau_balance"
        ),
    }
    months = grouped("per_credit", "levels", "SK_ID_BUREAU", agg_list(fixed.DELINQUENCY_PER_CREDIT), ctes)
    kinds = {
        "CONSUMER": "Consumer credit",
        "CAR": "Car loan",
        "MORTGAGE": "Mortgage",
        "CREDIT_CARD": "Credit card",
    }
    flags = {f"BUREAU_CREDIT_TYPE_{k}": f"CASE WHEN CREDIT_TYPE = {literal(v)} THEN 1 ELSE 0 END" for k, v in kinds.items()}
    derived = {
        **flags,
        "BUREAU_CREDIT_TYPE_OTHER": f"CASE WHEN CREDIT_TYPE IN {_in(kinds.values())} THEN 0 ELSE 1 END",
        "BUREAU_UNUSUAL_CURRENCY": "CASE WHEN CREDIT_CURRENCY = 'currency 1' THEN 0 ELSE 1 END",
        "NEW_PAYMENT_RATE_SUM": ratio("AMT_ANNUITY", "AMT_CREDIT_SUM"),
        "NEW_PAYMENT_RATE_SUM_DEBT": ratio("AMT_ANNUITY", "AMT_CREDIT_SUM_DEBT"),
        "NEW_PAYMENT_RATE_AMT_CREDIT_MAX_OVERDUE": ratio("AMT_ANNUITY", "AMT_CREDIT_MAX_OVERDUE"),
    }
    all_ctes = _credits_joined(
        months, "flagged", {**_tables("bureau"), "flagged": f"SELECT *, {items(derived)} FROM bureau"}
    )
    exprs = {
        **agg_list(fixed.BUREAU_SKEW, "BURO_"),
        **share_list({"CREDIT_ACTIVE": [*_CREDIT_VALUES["CREDIT_ACTIVE"], None]}, prefix="BURO_"),
        **agg_list(fixed.BUREAU_SKEW, "ACTIVE_", "CREDIT_ACTIVE = 'Active'"),
        **agg_list(fixed.BUREAU_SKEW, "CLOSED_", "CREDIT_ACTIVE = 'Closed'"),
    }
    return grouped("buro", "credits", "SK_ID_CURR", exprs, all_ctes)


def bureau_ratios_block() -> Block:
    months = _month_block(_STATUS_ALL)
    days = ["DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE"]
    cleaned = ", ".join(f"CASE WHEN {c} >= -20000 THEN {c} END AS {c}" for c in days)
    ctes = {
        **_tables("bureau"),
        "cleaned": (
            f"SELECT * REPLACE ({cleaned}, CASE WHEN CREDIT_TYPE IN {_in(fixed.MINOR_CREDIT_TYPES)} THEN 'Rare' "
            "ELSE CREDIT_TYPE END AS CREDIT_TYPE) FROM bureau"
        ),
        "with_ratios": "SELECT *, "
        + items(
            {
                "NEW_DAYS_CREDIT_UPDATE_DIFF": "DAYS_CREDIT - DAYS_CREDIT_UPDATE",
                "NEW_EARLY_PAID": "CASE WHEN DAYS_ENDDATE_FACT <= DAYS_CREDIT_ENDDATE THEN 1 ELSE 0 END",
                "NEW_OVERDUE_TO_CREDIT_SUM_RATIO": ratio("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM"),
                "NEW_OVERDUE_TO_DEBT_SUM_RATIO": ratio("AMT_CREDIT_SUM_OVERDUE", "AMT_CREDIT_SUM_DEBT"),
                "NEW_DEBT_SUM_TO_CREDIT_SUM_RATIO": ratio("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
                "NEW_ANNUITY_TO_CREDIT_SUM_RATIO": ratio("AMT_ANNUITY", "AMT_CREDIT_SUM"),
                "NEW_AMT_LIMIT_RATIO": ratio("AMT_CREDIT_SUM_LIMIT", "(1 + AMT_CREDIT_SUM)"),
            }
        )
        + " FROM cleaned",
    }
    carried = {c: ["mean"] for c in months.columns if c.startswith("STATUS_")}
    values = {
        "CREDIT_ACTIVE": [*_CREDIT_VALUES["CREDIT_ACTIVE"], None],
        "CREDIT_TYPE": ["Car loan", "Consumer credit", "Credit card", "Mortgage", "Rare", None],
    }
    exprs = {
        **agg_list(fixed.BUREAU_RATIOS | carried, "BUREAU_"),
        **share_list(values, ["mean", "sum"], "BUREAU_"),
    }
    return grouped("buro", "credits", "SK_ID_CURR", exprs, _credits_joined(months, "with_ratios", ctes))


# ---- earlier applications ----------------------------------------------------

_KNOWN_DAYS = ", ".join(f"nullif({c}, 365243) AS {c}" for c in fixed.PREVIOUS_DAY_COLUMNS)


def previous_base_block() -> Block:
    ctes = {
        **_tables("previous_application"),
        "prior": (
            f"SELECT *, {ratio('AMT_APPLICATION', 'AMT_CREDIT')} AS NEW_APP_CREDIT_PERC "
            f"FROM (SELECT * REPLACE ({_KNOWN_DAYS}) FROM previous_application)"
        ),
    }
    exprs = {
        **agg_list(fixed.PREVIOUS_BASE, "PREV_"),
        **share_list(_with_null(_PREVIOUS_VALUES), prefix="PREV_"),
        **agg_list(fixed.PREVIOUS_BASE, "PREV_NEW_APPROVED_", "NAME_CONTRACT_STATUS = 'Approved'"),
        **agg_list(fixed.PREVIOUS_BASE, "PREV_NEW_REFUSED_", "NAME_CONTRACT_STATUS = 'Refused'"),
    }
    return grouped("prev", "prior", "SK_ID_CURR", exprs, ctes)


def _merge(c: str, values, label: str, otherwise: str | None = None) -> str:
    return f"CASE WHEN {c} IN {_in(values)} THEN {literal(label)} ELSE {otherwise or c} END"


def _weekday() -> str:
    return _merge(
        "WEEKDAY_APPR_PROCESS_START",
        fixed.WEEKDAYS,
        "WEEK_DAY",
        _merge("WEEKDAY_APPR_PROCESS_START", fixed.WEEKEND, "WEEKEND"),
    )


def _hour(inside: str, outside: str) -> str:
    c = "HOUR_APPR_PROCESS_START"
    return f"CASE WHEN {c} BETWEEN 8 AND 17 THEN '{inside}' WHEN {c} IS NOT NULL THEN '{outside}' END"


def pos_per_loan_block() -> Block:
    exprs = {
        **agg_list(fixed.POS_PER_LOAN, "POS_"),
        **share_list({"NAME_CONTRACT_STATUS": fixed.POS_PER_LOAN_STATUSES}, ["sum"], "POS_"),
        "POS_NEW_IS_CREDIT_NOT_COMPLETED_ON_TIME": (
            "CASE WHEN min(CNT_INSTALMENT_FUTURE) = 0 AND count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Completed') = 0 "
            "THEN 1 ELSE 0 END"
        ),
    }
    return grouped("pos_loans", "POS_CASH_balance", "SK_ID_PREV", exprs, _tables("POS_CASH_balance"))


def instalments_per_loan_block() -> Block:
    ctes = {
        **_tables("installments_payments"),
        "paid": (
            "SELECT *, DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT AS NEW_DAYS_PAID_EARLIER, "
            "CASE WHEN DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT < 0 THEN 1 ELSE 0 END AS NEW_NUM_PAID_LATER FROM installments_payments"
        ),
    }
    paid, due = "coalesce(sum(AMT_PAYMENT), 0)", "coalesce(sum(AMT_INSTALMENT), 0)"
    exprs = {
        **agg_list(fixed.INSTALMENT_PER_LOAN, "INS_"),
        "INS_NEW_PAYMENT_PERC": ratio(paid, due),
        "INS_NEW_PAYMENT_DIFF": f"{due} - {paid}",
    }
    return grouped("ins_loans", "paid", "SK_ID_PREV", exprs, ctes)


def previous_nested_block() -> Block:
    ins, pos = instalments_per_loan_block(), pos_per_loan_block()
    replaced = {
        "WEEKDAY_APPR_PROCESS_START": _weekday(),
        "HOUR_APPR_PROCESS_START": _hour("working_hours", "off_hours"),
        "DAYS_DECISION": "CASE WHEN abs(DAYS_DECISION / 360.0e0) <= 1 THEN 1 ELSE 0 END",
        "NAME_TYPE_SUITE": _merge(
            "NAME_TYPE_SUITE", ["Unaccompanied"], "alone", _merge("NAME_TYPE_SUITE", fixed.COMPANIONS, "not_alone")
        ),
        "NAME_GOODS_CATEGORY": _merge("NAME_GOODS_CATEGORY", fixed.MINOR_GOODS, "others"),
        "NAME_SELLER_INDUSTRY": _merge("NAME_SELLER_INDUSTRY", fixed.MINOR_INDUSTRIES, "others"),
    }
    slack = "(DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE)"
    insured = "(AMT_CREDIT - AMT_GOODS_PRICE)"
    added = {
        "NEW_LOAN_RATE": ratio("AMT_APPLICATION", "AMT_CREDIT"),
        "NEW_CHURN_PREV": f"CASE WHEN {slack} >= 0 THEN '1' WHEN {slack} < 0 THEN '0' ELSE 'NaN' END",
        "NEW_INSURANCE": f"CASE WHEN {insured} > 0 THEN 1 WHEN {insured} <= 0 THEN 0 END",
    }
    ctes = {
        **ins.ctes,
        **pos.ctes,
        **_tables("previous_application"),
        "nested": (
            f"SELECT * REPLACE ({items(replaced)}), {items(added)} FROM previous_application "
            "LEFT JOIN ins_loans USING (SK_ID_PREV) LEFT JOIN pos_loans USING (SK_ID_PREV)"
        ),
    }
    values = {c: v for c, v in _PREVIOUS_VALUES.items() if c != "PRODUCT_COMBINATION"}
    values |= {
        "WEEKDAY_APPR_PROCESS_START": ["WEEKEND", "WEEK_DAY"],
        "HOUR_APPR_PROCESS_START": ["off_hours", "working_hours"],
        "NAME_TYPE_SUITE": ["alone", "not_alone"],
        "NAME_GOODS_CATEGORY": ["Audio/Video", "Mobile", "Photo / Cinema Equipment", "XNA", "others"],
        "NAME_SELLER_INDUSTRY": ["Connectivity", "Consumer electronics", "XNA", "others"],
        "NEW_CHURN_PREV": ["0", "1", "NaN"],
    }
    per_loan = {c: ["mean", "min", "max", "sum"] for c in [*ins.columns, *pos.columns]}
    exprs = {
        **agg_list(fixed.PREVIOUS_REGROUPED | per_loan, "PREV_"),
        **share_list(values, ["sum", "mean"], "PREV_"),
    }
    return grouped("prev", "nested", "SK_ID_CURR", exprs, ctes)


def previous_drop_first_block() -> Block:
    texts = list(_PREVIOUS_VALUES)
    no_xna = [f"nullif({c}, 'XNA') AS {c}" for c in texts]
    numbers = fixed.PREVIOUS_DAY_COLUMNS
    no_days = [f"nullif({c}, 365243) AS {c}" for c in numbers]
    back = "(DAYS_DECISION + CNT_PAYMENT * 30)"
    replaced = {
        "WEEKDAY_APPR_PROCESS_START": _weekday(),
        "HOUR_APPR_PROCESS_START": _hour("Working_Hours", "Off_Hours"),
        "NAME_PAYMENT_TYPE": f"CASE WHEN NAME_PAYMENT_TYPE NOT IN {_in(fixed.MINOR_PAYMENT_TYPES)} THEN NAME_PAYMENT_TYPE END",
        "CHANNEL_TYPE": _merge("CHANNEL_TYPE", fixed.MINOR_CHANNELS, "Others_Type"),
        "NAME_TYPE_SUITE": _merge("NAME_TYPE_SUITE", fixed.COMPANIONS, "not_alone"),
        "NAME_SELLER_INDUSTRY": _merge("NAME_SELLER_INDUSTRY", fixed.MINOR_INDUSTRIES, "Other_Ind"),
        "NAME_GOODS_CATEGORY": _merge("NAME_GOODS_CATEGORY", fixed.MINOR_GOODS, "Other_Cat"),
        "NAME_CASH_LOAN_PURPOSE": _merge("NAME_CASH_LOAN_PURPOSE", fixed.MINOR_PURPOSES, "Others"),
        "NFLAG_INSURED_ON_APPROVAL": "CASE NFLAG_INSURED_ON_APPROVAL WHEN 1 THEN '1.0' WHEN 0 THEN '0.0' END",
    }
    added = {
        "NEW_RETURN_DAY": back,
        "NEW_DAYS_TERMINATION_diff": f"DAYS_TERMINATION - {back}",
        "NEW_AMT_DOWN_PAYMENT_rate": ratio("AMT_DOWN_PAYMENT", "(AMT_CREDIT + 0.01)"),
        "NEW_AMT_SPEND_TO_PRODUCT": ratio("AMT_GOODS_PRICE", "AMT_CREDIT"),
        "NEW_APP_CREDIT_PERC": ratio("AMT_APPLICATION", "AMT_CREDIT"),
    }
    ctes = {
        **_tables("previous_application"),
        "no_sentinels": f"SELECT * REPLACE ({', '.join(no_xna + no_days)}) FROM previous_application",
        "prior": f"SELECT * REPLACE ({items(replaced)}), {items(added)} FROM no_sentinels",
    }
    values = {
        "NAME_CONTRACT_STATUS": ["Canceled", "Refused", "Unused offer", None],
        "WEEKDAY_APPR_PROCESS_START": ["WEEK_DAY", None],
        "HOUR_APPR_PROCESS_START": ["Working_Hours", None],
        "NAME_CONTRACT_TYPE": ["Consumer loans", "Revolving loans", None],
        "NAME_CASH_LOAN_PURPOSE": ["Repairs", "XAP", None],
        "NAME_PAYMENT_TYPE": [None],
        "CODE_REJECT_REASON": ["HC", "LIMIT", "SCO", "XAP", None],
        "NAME_TYPE_SUITE": ["not_alone", None],
        "NAME_CLIENT_TYPE": ["Refreshed", "Repeater", None],
        "NAME_GOODS_CATEGORY": ["Mobile", "Other_Cat", "Photo / Cinema Equipment", None],
        "NAME_PORTFOLIO": ["Cash", "POS", None],
        "CHANNEL_TYPE": ["Country-wide", "Others_Type", "Regional / Local", "Stone", None],
        "NAME_SELLER_INDUSTRY": ["Consumer electronics", "Other_Ind", None],
        "NAME_YIELD_GROUP": ["low_normal", "middle", None],
        "PRODUCT_COMBINATION": ["Cash", "POS mobile with interest", None],
        "NFLAG_INSURED_ON_APPROVAL": ["1.0", None],
    }
    exprs = {
        **agg_list(fixed.PREVIOUS_DROP_FIRST, "PREV_"),
        **share_list(values, ["max", "min", "sum"], "PREV_"),
    }
    return grouped("prev", "prior", "SK_ID_CURR", exprs, ctes)


_PREVIOUS_NUMBERS = (
    "AMT_ANNUITY AMT_APPLICATION AMT_CREDIT AMT_DOWN_PAYMENT AMT_GOODS_PRICE RATE_DOWN_PAYMENT RATE_INTEREST_PRIMARY "
    "RATE_INTEREST_PRIVILEGED HOUR_APPR_PROCESS_START DAYS_DECISION DAYS_FIRST_DRAWING DAYS_FIRST_DUE "
    "DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE DAYS_TERMINATION CNT_PAYMENT SELLERPLACE_AREA NFLAG_LAST_APPL_IN_DAY "
    "NFLAG_INSURED_ON_APPROVAL APP_CREDIT_PERC NEW_CREDIT_TO_ANNUITY_RATIO NEW_DOWN_PAYMENT_TO_CREDIT NEW_TOTAL_PAYMENT "
    "NEW_TOTAL_PAYMENT_TO_AMT_CREDIT SIMPLE_INTERESTS"
).split()

# Aggregates whose spread over applicants is under the limit in the stand-ins.
_FLAT_PREVIOUS = {
    f"PREV_{name}"
    for name in """
    RATE_DOWN_PAYMENT_VAR RATE_INTEREST_PRIMARY_MIN RATE_INTEREST_PRIMARY_MAX RATE_INTEREST_PRIMARY_MEAN
    RATE_INTEREST_PRIMARY_VAR RATE_INTEREST_PRIVILEGED_VAR NFLAG_LAST_APPL_IN_DAY_MAX NFLAG_LAST_APPL_IN_DAY_MEAN
    NFLAG_LAST_APPL_IN_DAY_VAR NFLAG_INSURED_ON_APPROVAL_VAR APP_CREDIT_PERC_MIN APP_CREDIT_PERC_MAX
    APP_CREDIT_PERC_MEAN APP_CREDIT_PERC_VAR NEW_CREDIT_TO_ANNUITY_RATIO_MAX NEW_DOWN_PAYMENT_TO_CREDIT_MIN
    NEW_DOWN_PAYMENT_TO_CREDIT_MAX NEW_DOWN_PAYMENT_TO_CREDIT_MEAN NEW_DOWN_PAYMENT_TO_CREDIT_VAR
    SIMPLE_INTERESTS_MAX SIMPLE_INTERESTS_MEAN SIMPLE_INTERESTS_VAR
    """.split()
}


def previous_capped_block() -> Block:
    caps = ", ".join(
        f"quantile_cont({c}, 0.99) + 1.5 * (quantile_cont({c}, 0.99) - quantile_cont({c}, 0.01)) AS cap_{c}"
        for c in fixed.PREVIOUS_OUTLIER_COLUMNS
    )
    capped = ", ".join(
        f"CASE WHEN {c} > (SELECT cap_{c} FROM caps) THEN (SELECT cap_{c} FROM caps) ELSE {c} END AS {c}"
        for c in fixed.PREVIOUS_OUTLIER_COLUMNS
    )
    total = "(AMT_ANNUITY * CNT_PAYMENT)"
    added = {
        "APP_CREDIT_PERC": ratio("AMT_APPLICATION", "AMT_CREDIT"),
        "NEW_CREDIT_TO_ANNUITY_RATIO": ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "NEW_DOWN_PAYMENT_TO_CREDIT": ratio("AMT_DOWN_PAYMENT", "AMT_CREDIT"),
        "NEW_TOTAL_PAYMENT": total,
        "NEW_TOTAL_PAYMENT_TO_AMT_CREDIT": ratio(total, "AMT_CREDIT"),
        "SIMPLE_INTERESTS": ratio(f"({ratio(total, 'AMT_CREDIT')} - 1)", "CNT_PAYMENT"),
    }
    ctes = {
        **_tables("previous_application"),
        "caps": f"SELECT {caps} FROM previous_application",
        "capped": f"SELECT * REPLACE ({capped}, {_KNOWN_DAYS}) FROM previous_application",
        "with_interest": f"SELECT *, {items(added)} FROM capped",
    }
    spec = {c: fixed.FIVE_FUNCTIONS for c in _PREVIOUS_NUMBERS}
    block = grouped("prev_capped", "with_interest", "SK_ID_CURR", agg_list(spec, "PREV_"), ctes)
    block.columns = [c for c in block.columns if c not in _FLAT_PREVIOUS]
    return block


def previous_history_ctes() -> dict[str, str]:
    """Totals and the latest application; a ratio over zero ends up as 0."""

    def over(a: str, b: str) -> str:
        return f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / {b} WHEN {a} <> 0 THEN 0 END"

    return {
        **_tables("previous_application"),
        "totals": (
            "SELECT SK_ID_CURR, coalesce(sum(AMT_CREDIT), 0) AS approved, coalesce(sum(AMT_APPLICATION), 0) AS asked, "
            "count(SK_ID_PREV) AS n, count(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS n_approved "
            "FROM previous_application GROUP BY SK_ID_CURR"
        ),
        "latest": (
            "SELECT SK_ID_CURR, DAYS_DECISION AS LAST_APPEAL, NAME_CONTRACT_STATUS AS STATUS_OF_LAST_APPEAL FROM ("
            "SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC NULLS LAST, SK_ID_PREV) AS nth "
            "FROM previous_application) WHERE nth = 1"
        ),
        "history": (
            "SELECT SK_ID_CURR, asked AS AMOUNT_OF_mean_total, n AS AMOUNT_OF_TOTAL_APPEAL, LAST_APPEAL, STATUS_OF_LAST_APPEAL, "
            f'{over("approved", "asked")} AS "APPROVED_CREDIT/TOTAL_CREDIT", {over("n_approved", "n")} AS "AMT_APPROVED/TOTAL" '
            "FROM totals JOIN latest USING (SK_ID_CURR)"
        ),
    }


_INSTALMENT_ORDER = (
    "SK_ID_PREV NUM_INSTALMENT_VERSION NUM_INSTALMENT_NUMBER DAYS_INSTALMENT DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT"
).split()

# Dummies left at sf0.01 after rare categories are merged, first of each column dropped.
_LAST_DUMMIES = {
    "FLAG_LAST_APPL_PER_CONTRACT": ["Y"],
    "NAME_CASH_LOAN_PURPOSE": ["Missing", "Rare", "Repairs", "Urgent needs"],
    "NAME_SELLER_INDUSTRY": ["Consumer electronics", "Missing", "Rare"],
    "PRODUCT_COMBINATION": ["POS mobile with interest", "Rare"],
    "WEEKDAY_APPR_PROCESS_START": ["MONDAY", "SATURDAY", "SUNDAY", "WEDNESDAY"],
    "CHANNEL_TYPE": ["Car dealer", "Country-wide", "Regional / Local", "Stone"],
    "NAME_GOODS_CATEGORY": ["Jewelry", "Missing", "Mobile", "Photo / Cinema Equipment", "Rare"],
    "NAME_PORTFOLIO": ["Cash", "Missing", "POS"],
    "NAME_CONTRACT_TYPE": ["Consumer loans", "Revolving loans"],
    "NAME_PAYMENT_TYPE": ["Missing", "Non-cash from your account"],
    "NAME_TYPE_SUITE": ["Missing", "Spouse, partner", "Unaccompanied"],
}


def previous_last_block() -> Block:
    texts = [*_PREVIOUS_VALUES, "STATUS_OF_LAST_APPEAL"]
    blank = ", ".join(f"CASE WHEN {c} NOT IN ('XAP', 'XNA') THEN {c} END AS {c}" for c in texts)
    required = " AND ".join(f"{quoted(c)} IS NOT NULL" for c in fixed.LAST_REQUIRED)
    paid_required = " AND ".join(f"{quoted(c)} IS NOT NULL" for c in fixed.LAST_PAYMENT_REQUIRED)
    rare = ", ".join(
        f"CASE WHEN {c} IN (SELECT {c} FROM complete WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) * 100 <= {t} * (SELECT count(*) FROM complete)) "
        f"OR ({c} IS NULL AND (SELECT count(*) FROM complete WHERE {c} IS NULL) * 100 <= {t} * (SELECT count(*) FROM complete)) "
        f"THEN 'Rare' ELSE {c} END AS {c}"
        for c, t in fixed.LAST_RARE_PERCENT.items()
    )

    def timing(diff: str, negative: str, other: str) -> str:
        return f"CASE WHEN {diff} < 0 THEN '{negative}' WHEN {diff} = 0 THEN 'Paid in Time' ELSE '{other}' END"

    labels = {
        "Delaying_Number-CAT": timing("Delaying_Number", "Paid Earlier", "Paid Later"),
        "started_on_time-CAT": timing("(DAYS_FIRST_DUE - DAYS_LAST_DUE_1ST_VERSION)", "Paid Later", "Paid Earlier"),
        "finished_on_time-CAT": timing("(DAYS_LAST_DUE - DAYS_TERMINATION)", "Paid Later", "Paid Earlier"),
    }
    filled = ", ".join(f"coalesce({c}, 'Missing') AS {c}" for c in texts)
    order = ", ".join(f"{c} NULLS FIRST" for c in _INSTALMENT_ORDER)
    ctes = {
        **previous_history_ctes(),
        **_tables("application_train", "installments_payments"),
        "first_application": (
            "SELECT * EXCLUDE (nth, SK_ID_PREV) FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY SK_ID_PREV) AS nth "
            "FROM previous_application) WHERE nth = 1"
        ),
        "first_instalment": (
            "SELECT * EXCLUDE (nth, SK_ID_PREV), DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS Delaying_Number, "
            "CASE WHEN AMT_INSTALMENT <> 0 THEN AMT_PAYMENT / AMT_INSTALMENT WHEN AMT_PAYMENT <> 0 THEN 0 END AS Paying_Rate "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY {order}) AS nth FROM installments_payments) WHERE nth = 1"
        ),
        "combined": (
            "SELECT * FROM (SELECT SK_ID_CURR FROM application_train) LEFT JOIN history USING (SK_ID_CURR) "
            "LEFT JOIN first_application USING (SK_ID_CURR) LEFT JOIN first_instalment USING (SK_ID_CURR)"
        ),
        "complete": f"SELECT * FROM (SELECT * REPLACE ({blank}) FROM combined) WHERE {required}",
        "labelled": f"SELECT *, {items(labels)} FROM (SELECT * REPLACE ({rare}) FROM complete) WHERE {paid_required}",
        "filled_in": f"SELECT * REPLACE ({filled}) FROM labelled",
    }
    numbers = [
        "AMOUNT_OF_mean_total",
        "AMOUNT_OF_TOTAL_APPEAL",
        "LAST_APPEAL",
        "APPROVED_CREDIT/TOTAL_CREDIT",
        "AMT_APPROVED/TOTAL",
        *[
            c
            for c in _PREVIOUS_NUMBERS[:19]
            if c not in ("DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION")
        ],
        *_INSTALMENT_ORDER[1:],
        "Paying_Rate",
        "Delaying_Number",
    ]
    exprs = {
        **{c: quoted(c) for c in numbers},
        **{c: f"dense_rank() OVER (ORDER BY {quoted(c)}) - 1" for c in fixed.LAST_ORDINAL},
        **dummy_list(_LAST_DUMMIES),
    }
    ctes["prev_last"] = f"SELECT SK_ID_CURR, {items(exprs)} FROM filled_in"
    return Block("prev_last", ctes, list(exprs))


# ---- loan balances and instalments -------------------------------------------


def pos_base_block() -> Block:
    exprs = {
        **agg_list(fixed.POS_BASE, "POS_"),
        **share_list({"NAME_CONTRACT_STATUS": [*_POS_STATUSES, None]}, prefix="POS_"),
        "POS_NEW_COUNT": "count(*)",
    }
    return grouped("pos", "POS_CASH_balance", "SK_ID_CURR", exprs, _tables("POS_CASH_balance"))


def pos_flat_block() -> Block:
    exprs = {**agg_list(fixed.POS_FLAT), **share_list({"NAME_CONTRACT_STATUS": _POS_STATUSES[1:]})}
    return grouped("pos", "POS_CASH_balance", "SK_ID_CURR", exprs, _tables("POS_CASH_balance"))


def pos_two_level_block() -> Block:
    merged = _merge("NAME_CONTRACT_STATUS", fixed.MINOR_POS_STATUSES, "Others")
    ctes = {
        **_tables("POS_CASH_balance"),
        "adjourned": (
            f"SELECT * REPLACE ({merged} AS NAME_CONTRACT_STATUS), SK_DPD - SK_DPD_DEF AS NEW_ADJOURNMENT FROM POS_CASH_balance"
        ),
    }
    level_one = {
        **agg_list(fixed.POS_LEVEL_ONE),
        **share_list({"NAME_CONTRACT_STATUS": fixed.POS_LEVEL_ONE_STATUSES}, ["sum"]),
    }
    loans = grouped("pos_loans", "adjourned", "SK_ID_PREV", level_one, ctes)
    return grouped(
        "pos", "pos_loans", "SK_ID_CURR_MAX", agg_list(fixed.POS_LEVEL_TWO, "POS_"), loans.ctes, "SK_ID_CURR"
    )


def instalment_base_block() -> Block:
    late = "(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)"
    added = {
        "NEW_PAYMENT_PERC": ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
        "NEW_PAYMENT_DIFF": "AMT_INSTALMENT - AMT_PAYMENT",
        "NEW_DPD": f"CASE WHEN {late} > 0 THEN {late} ELSE 0 END",
        "NEW_DBD": f"CASE WHEN {late} < 0 THEN -{late} ELSE 0 END",
    }
    ctes = {
        **_tables("installments_payments"),
        "paid": f"SELECT *, {items(added)} FROM installments_payments",
    }
    exprs = {**agg_list(fixed.INSTALMENT_BASE, "INSTAL_"), "INSTAL_NEW_COUNT": "count(*)"}
    return grouped("instal", "paid", "SK_ID_CURR", exprs, ctes)


def instalments_two_level_block() -> Block:
    ctes = {
        **_tables("installments_payments"),
        "paid": (
            "SELECT *, DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT AS NEW_DELAY, AMT_INSTALMENT - AMT_PAYMENT AS NEW_PAYMENT_DIFF "
            "FROM installments_payments"
        ),
    }
    level_one = {
        **agg_list(fixed.INSTALMENT_LEVEL_ONE),
        **{f"NUM_INSTALMENT_VERSION_{v}_SUM": f"count(*) FILTER (WHERE NUM_INSTALMENT_VERSION = {v})" for v in fixed.INSTALMENT_VERSIONS},
        "NEW_DAYS_INSTALMENT_NUMBER": "max(DAYS_INSTALMENT) - min(DAYS_INSTALMENT)",
        "NEW_AMT_INSTALMENT_DIFF": "max(AMT_INSTALMENT) - min(AMT_INSTALMENT)",
    }
    loans = grouped("ins_loans", "paid", "SK_ID_PREV", level_one, ctes)
    return grouped(
        "instal",
        "ins_loans",
        "SK_ID_CURR_MAX",
        agg_list(fixed.INSTALMENT_LEVEL_TWO, "INSTAL_"),
        loans.ctes,
        "SK_ID_CURR",
    )


def instalment_status_block() -> Block:
    days = "(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT)"
    status = f"CASE WHEN {days} < 0 THEN 'Late' WHEN {days} > 0 THEN 'Early' WHEN {days} = 0 THEN 'In Time' ELSE 'No Payment' END"
    ctes = {
        **_tables("installments_payments"),
        "paid_or_zero": "SELECT * REPLACE (coalesce(AMT_PAYMENT, 0) AS AMT_PAYMENT) FROM installments_payments",
        "with_status": (
            f"SELECT *, {status} AS NEW_INSTALMENT_PAYMENT_STATUS, CASE WHEN {days} < 0 THEN 1 ELSE 0 END AS NEW_INS_IS_LATE, "
            f"{ratio('AMT_PAYMENT', 'AMT_INSTALMENT')} * 100 AS NEW_INSTALMENT_PAYMENT_RATE FROM paid_or_zero"
        ),
    }
    exprs = {
        **agg_list(fixed.INSTALMENT_STATUS),
        **share_list({"NEW_INSTALMENT_PAYMENT_STATUS": ["In Time", "Late", "No Payment"]}),
    }
    return grouped("instal", "with_status", "SK_ID_CURR", exprs, ctes)


def instalments_with_pos_block() -> Block:
    ins, pos = instalment_status_block(), pos_flat_block()
    text = "SELECT * FROM instal JOIN pos USING (SK_ID_CURR)"
    return Block("ins_pos", {**ins.ctes, **pos.ctes, "ins_pos": text}, [*ins.columns, *pos.columns])


# ---- cards -------------------------------------------------------------------

_CARD_NUMBERS = [*fixed.CARD_BEHAVIOUR]
_CARD_SHARES = {"NAME_CONTRACT_STATUS": [*_CARD_STATUSES, None]}


def card_base_block() -> Block:
    exprs = {
        **agg_list({c: fixed.FIVE_FUNCTIONS for c in _CARD_NUMBERS}, "CC_"),
        **share_list(_CARD_SHARES, fixed.FIVE_FUNCTIONS, "CC_"),
        "CC_NEW_COUNT": "count(*)",
    }
    return grouped("cc", "credit_card_balance", "SK_ID_CURR", exprs, _tables("credit_card_balance"))


def card_nulled_block() -> Block:
    drawings = ["AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT"]
    nulled = ", ".join(f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" for c in drawings)
    ctes = {
        **_tables("credit_card_balance"),
        "card_max": "SELECT SK_ID_CURR, max(CNT_INSTALMENT_MATURE_CUM) AS number_of_instalments FROM credit_card_balance GROUP BY SK_ID_CURR",
        "card_rows": f"SELECT * FROM (SELECT * REPLACE ({nulled}) FROM credit_card_balance) LEFT JOIN card_max USING (SK_ID_CURR)",
    }
    exprs = {
        **agg_list({c: fixed.FIVE_FUNCTIONS for c in [*_CARD_NUMBERS, "number_of_instalments"]}, "CC_"),
        **share_list(_CARD_SHARES, fixed.FIVE_FUNCTIONS, "CC_"),
        "CC_COUNT": "count(*)",
    }
    return grouped("cc", "card_rows", "SK_ID_CURR", exprs, ctes)


def card_behaviour_block() -> Block:
    ctes = {
        **_tables("credit_card_balance"),
        "card_loans": (
            "SELECT SK_ID_CURR, SK_ID_PREV, max(CNT_INSTALMENT_MATURE_CUM) AS inst, "
            "count(*) FILTER (WHERE SK_DPD IS DISTINCT FROM 0) AS late FROM credit_card_balance GROUP BY ALL"
        ),
        "card_customers": (
            "SELECT SK_ID_CURR, count(*) AS NUMBER_OF_LOANS_PER_CUSTOMER, avg(late) AS DPD_COUNT, "
            "trunc(coalesce(sum(inst), 0) / count(*)) AS INSTALLMENTS_PER_LOAN FROM card_loans GROUP BY SK_ID_CURR"
        ),
        "card_rows": "SELECT * FROM credit_card_balance JOIN card_customers USING (SK_ID_CURR)",
    }
    written_back = {
        "INSTALLMENTS_PER_LOAN": ["sum", "mean", "min", "max"],
        "NUMBER_OF_LOANS_PER_CUSTOMER": ["mean"],
        "DPD_COUNT": ["mean"],
    }
    exprs = {
        **agg_list(fixed.CARD_BEHAVIOUR | written_back, "CCB_"),
        **share_list({"NAME_CONTRACT_STATUS": ["Active"]}, ["sum", "mean", "min", "max"], "CCB_"),
        "CCB_PERCENTAGE_MIN_MISSED_PAYMENTS_MEAN": (
            "100.0e0 * count(*) FILTER (WHERE AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY) / count(*)"
        ),
        "CCB_CASH_CARD_RATIO_MEAN": ratio("sum(AMT_DRAWINGS_ATM_CURRENT)", "sum(AMT_DRAWINGS_CURRENT)") + " * 100",
        "CCB_DRAWINGS_RATIO_MEAN": ratio("sum(AMT_DRAWINGS_CURRENT)", "sum(CNT_DRAWINGS_CURRENT)") + " * 100",
    }
    return grouped("ccb", "card_rows", "SK_ID_CURR", exprs, ctes)


def card_means_block() -> Block:
    def smoothed(a: str, b: str) -> str:
        return ratio(f"(avg({a}) + 1)", f"(avg({b}) + 1)")

    exprs = {c: f"avg({c[3:-5]})" for c in fixed.CARD_MEANS_KEPT if not c.startswith("CC_NEW")}
    exprs |= {
        "CC_NEW_LOAN_TO_CREDIT_LIMIT_RATE": smoothed("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
        "CC_NEW_PAID_AMOUNT_RATE": smoothed("AMT_PAYMENT_TOTAL_CURRENT", "AMT_TOTAL_RECEIVABLE") + " * 100",
        "CC_NEW_AMT_PER_ATM_DRAWING_MEAN": smoothed("AMT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_ATM_CURRENT"),
        "CC_NEW_AMT_PER_POS_DRAWING_MEAN": smoothed("AMT_DRAWINGS_POS_CURRENT", "CNT_DRAWINGS_POS_CURRENT"),
    }
    return grouped("cc", "credit_card_balance", "SK_ID_CURR", exprs, _tables("credit_card_balance"))


# ---- wide tables -------------------------------------------------------------


def wide_base_block() -> Block:
    return left_joined(
        "wide",
        applicant_base_block(),
        bureau_base_block(),
        previous_base_block(),
        pos_base_block(),
        instalment_base_block(),
        card_base_block(),
    )


def wide_nested_block() -> Block:
    return left_joined(
        "wide", applicant_nulls_block(), previous_nested_block(), card_behaviour_block(), bureau_score_block()
    )


def wide_ratios_block() -> Block:
    return left_joined(
        "wide", applicant_nulls_block(), previous_nested_block(), card_behaviour_block(), bureau_ratios_block()
    )


def wide_age_block() -> Block:
    return left_joined(
        "wide",
        applicant_age_block(),
        bureau_skew_block(),
        previous_drop_first_block(),
        pos_two_level_block(),
        instalments_two_level_block(),
        card_nulled_block(),
    )


def wide_rare_block() -> Block:
    applicant, last, card = applicant_rare_block(), previous_last_block(), card_means_block()
    flags = (
        "SELECT *, CASE WHEN SK_ID_CURR IN (SELECT SK_ID_CURR FROM prev_last) THEN 1 ELSE 0 END AS NEW_HAS_APPLICATION, "
        "CASE WHEN SK_ID_CURR IN (SELECT SK_ID_CURR FROM credit_card_balance) THEN 1 ELSE 0 END AS NEW_FLAG_CCB FROM applicant"
    )
    flagged = Block(
        "flagged_applicant",
        {**applicant.ctes, **last.ctes, **card.ctes, "flagged_applicant": flags},
        [*applicant.columns, "NEW_HAS_APPLICATION", "NEW_FLAG_CCB"],
    )
    renamed = ", ".join(f"{quoted(c)} AS {quoted('BK_' + c)}" for c in last.columns)
    history = Block(
        "bk", {**last.ctes, "bk": f"SELECT SK_ID_CURR, {renamed} FROM prev_last"}, ["BK_" + c for c in last.columns]
    )
    return left_joined(
        "wide",
        flagged,
        filled_with_behaviour_block(),
        instalments_with_pos_block(),
        card,
        history,
        previous_capped_block(),
    )


# ---- registered queries ------------------------------------------------------


def _recipe(build: Callable[[CreditTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: settle(build(CreditTables(spark, sf_dir)))


#: Buckets of the co-partitioned wide table: so many tasks join it.
WIDE_BUCKETS = 32

_APP = ("application_train", "application_test")

QUERIES: dict[str, Query] = {
    "pipe_applicant": _recipe(lambda t: plans.applicant_base(t[_APP[0]], t[_APP[1]])),
    "pipe_applicant_nulls": _recipe(lambda t: plans.applicant_label_nulls(t[_APP[0]], t[_APP[1]])),
    "pipe_applicant_age": _recipe(lambda t: plans.applicant_age(t[_APP[0]], t[_APP[1]])),
    "pipe_applicant_rare": _recipe(lambda t: plans.applicant_rare(t[_APP[0]], t[_APP[1]])),
    "pipe_parent_child": _recipe(lambda t: plans.bureau_base(t["bureau"], t["bureau_balance"])),
    "pipe_parent_child_score": _recipe(lambda t: plans.bureau_score(t["bureau"], t["bureau_balance"])),
    "pipe_parent_child_filled": _recipe(lambda t: plans.bureau_filled(t["bureau"], t["bureau_balance"])),
    "pipe_behaviour_counts": _recipe(lambda t: plans.bureau_behaviour(t["bureau"])),
    "pipe_parent_child_behaviour": _recipe(
        lambda t: plans.bureau_filled_with_behaviour(t["bureau"], t["bureau_balance"])
    ),
    "pipe_parent_child_skew": _recipe(lambda t: plans.bureau_skew(t["bureau"], t["bureau_balance"])),
    "pipe_parent_child_ratios": _recipe(lambda t: plans.bureau_ratios(t["bureau"], t["bureau_balance"])),
    "pipe_prior": _recipe(lambda t: plans.previous_base(t["previous_application"])),
    "pipe_prior_nested": _recipe(
        lambda t: plans.previous_regrouped(
            t["previous_application"],
            plans.instalments_per_loan(t["installments_payments"]),
            plans.pos_per_loan(t["POS_CASH_balance"]),
        )
    ),
    "pipe_prior_drop_first": _recipe(lambda t: plans.previous_drop_first(t["previous_application"])),
    "pipe_prior_capped": _recipe(lambda t: plans.previous_capped(t["previous_application"])),
    "pipe_prior_last": _recipe(
        lambda t: plans.previous_last(t["previous_application"], t["application_train"], t["installments_payments"])
    ),
    "pipe_child_one_level": _recipe(lambda t: plans.instalment_base(t["installments_payments"])),
    "pipe_child_one_level_shares": _recipe(lambda t: plans.pos_base(t["POS_CASH_balance"])),
    "pipe_child_flat": _recipe(lambda t: plans.pos_flat(t["POS_CASH_balance"])),
    "pipe_child_two_level": _recipe(lambda t: plans.instalments_two_level(t["installments_payments"])),
    "pipe_child_two_level_status": _recipe(lambda t: plans.pos_two_level(t["POS_CASH_balance"])),
    "pipe_child_status": _recipe(lambda t: plans.instalment_status(t["installments_payments"])),
    "pipe_child_inner": _recipe(
        lambda t: plans.instalments_with_pos(t["installments_payments"], t["POS_CASH_balance"])
    ),
    "pipe_card_all": _recipe(lambda t: plans.card_base(t["credit_card_balance"])),
    "pipe_card_nulled": _recipe(lambda t: plans.card_nulled(t["credit_card_balance"])),
    "pipe_card_behaviour": _recipe(lambda t: plans.card_behaviour(t["credit_card_balance"])),
    "pipe_card_means": _recipe(lambda t: plans.card_means(t["credit_card_balance"])),
    "pipe_wide": _recipe(plans.wide_base),
    "pipe_wide_bucketed": _recipe(lambda t: plans.wide_base(t, buckets=WIDE_BUCKETS)),
    "pipe_wide_nested": _recipe(plans.wide_nested),
    "pipe_wide_ratios": _recipe(plans.wide_ratios),
    "pipe_wide_age": _recipe(plans.wide_age),
    "pipe_wide_rare": _recipe(plans.wide_rare),
}


def oracle_sql() -> dict[str, str]:
    blocks = {
        "pipe_applicant": applicant_base_block,
        "pipe_applicant_nulls": applicant_nulls_block,
        "pipe_applicant_age": applicant_age_block,
        "pipe_applicant_rare": applicant_rare_block,
        "pipe_parent_child": bureau_base_block,
        "pipe_parent_child_score": bureau_score_block,
        "pipe_parent_child_filled": bureau_filled_block,
        "pipe_behaviour_counts": bureau_behaviour_block,
        "pipe_parent_child_behaviour": filled_with_behaviour_block,
        "pipe_parent_child_skew": bureau_skew_block,
        "pipe_parent_child_ratios": bureau_ratios_block,
        "pipe_prior": previous_base_block,
        "pipe_prior_nested": previous_nested_block,
        "pipe_prior_drop_first": previous_drop_first_block,
        "pipe_prior_capped": previous_capped_block,
        "pipe_prior_last": previous_last_block,
        "pipe_child_one_level": instalment_base_block,
        "pipe_child_one_level_shares": pos_base_block,
        "pipe_child_flat": pos_flat_block,
        "pipe_child_two_level": instalments_two_level_block,
        "pipe_child_two_level_status": pos_two_level_block,
        "pipe_child_status": instalment_status_block,
        "pipe_child_inner": instalments_with_pos_block,
        "pipe_card_all": card_base_block,
        "pipe_card_nulled": card_nulled_block,
        "pipe_card_behaviour": card_behaviour_block,
        "pipe_card_means": card_means_block,
        "pipe_wide": wide_base_block,
        "pipe_wide_bucketed": wide_base_block,
        "pipe_wide_nested": wide_nested_block,
        "pipe_wide_ratios": wide_ratios_block,
        "pipe_wide_age": wide_age_block,
        "pipe_wide_rare": wide_rare_block,
    }
    return {name: block().query() for name, block in blocks.items()}
