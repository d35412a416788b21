"""Fixed values of the credit-data recipes.

Everything in this module must equal the published feature definitions for the
results to be right: aggregation lists, category groups, sentinels and
thresholds, stated as plain text.
"""

from __future__ import annotations


def spec(text: str) -> dict[str, list[str]]:
    """``column: function function ...`` lines to an aggregation spec."""
    out = {}
    for line in text.strip().splitlines():
        column, functions = line.split(":")
        out[column.strip()] = functions.split()
    return out


def names(text: str) -> list[str]:
    """One name per line."""
    return [line.strip() for line in text.strip().splitlines()]


# ---- fixed values: keys, sentinels, thresholds -------------------------------

IDS = ["TARGET", "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "index"]
MISSING_DAYS = 365243
MISSING_TEXT = "XNA"
EARLIEST_DAY = -20000

# ---- fixed values: applicants ------------------------------------------------

BINARY_COLUMNS = ["CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]
AGE_EDGES = [20.0, 30.0, 40.0, 50.0, 60.0]
AGE_LABELS = ["Young", "Adult 1", "Adult 2", "Adult 3", "Adult 4"]
NOMINAL_COLUMNS = names("""
    EMERGENCYSTATE_MODE
    FONDKAPREMONT_MODE
    HOUSETYPE_MODE
    NAME_CONTRACT_TYPE
    NAME_FAMILY_STATUS
    NAME_HOUSING_TYPE
    NAME_INCOME_TYPE
    NAME_TYPE_SUITE
    OCCUPATION_TYPE
    ORGANIZATION_TYPE
    WALLSMATERIAL_MODE
    WEEKDAY_APPR_PROCESS_START
""")

# ---- fixed values: external credits ------------------------------------------

STATUS_CODES = ["0", "1", "2", "3", "4", "5", "C", "X"]
STATUS_ZERO_CODES = ["X", "C"]
MINOR_CREDIT_TYPES = names("""
    Microloan
    Loan for business development
    Another type of loan
    Unknown type of loan
    Loan for working capital replenishment
    Loan for purchase of shares (margin lending)
    Cash loan (non-earmarked)
    Real estate loan
    Loan for the purchase of equipment
    Interbank credit
    Mobile operator loan
""")
RARE_CREDIT_TYPES = ["Car loan", "Mortgage", *MINOR_CREDIT_TYPES]

BUREAU_BASE = spec("""
    DAYS_CREDIT: min max mean var
    DAYS_CREDIT_ENDDATE: min max mean
    DAYS_CREDIT_UPDATE: mean
    CREDIT_DAY_OVERDUE: max mean
    AMT_CREDIT_MAX_OVERDUE: mean
    AMT_CREDIT_SUM: max mean sum
    AMT_CREDIT_SUM_DEBT: max mean sum
    AMT_CREDIT_SUM_OVERDUE: mean
    AMT_CREDIT_SUM_LIMIT: mean sum
    AMT_ANNUITY: max mean
    CNT_CREDIT_PROLONG: sum
    MONTHS_BALANCE_MIN: min
    MONTHS_BALANCE_MAX: max
    MONTHS_BALANCE_SIZE: mean sum
""")
BUREAU_SCORE = spec("""
    SK_ID_CURR: count
    DAYS_CREDIT: min max
    CREDIT_DAY_OVERDUE: sum mean max
    DAYS_CREDIT_ENDDATE: max min
    DAYS_ENDDATE_FACT: max min
    AMT_CREDIT_MAX_OVERDUE: mean max min
    CNT_CREDIT_PROLONG: sum mean max min
    AMT_CREDIT_SUM: mean max min
    AMT_CREDIT_SUM_DEBT: sum mean max
    AMT_CREDIT_SUM_LIMIT: sum mean max
    AMT_CREDIT_SUM_OVERDUE: sum mean max
    DAYS_CREDIT_UPDATE: max min
    AMT_ANNUITY: sum mean
    MONTHS_BALANCE_COUNT: sum
    STATUS_0_SUM: sum
    STATUS_0_MEAN: mean
    STATUS_C_SUM: sum
    STATUS_C_MEAN: mean
    NEW_MONTHS_CREDIT: count sum mean max min
""")
BUREAU_SCORE_SUBSET = {c: f for c, f in BUREAU_BASE.items() if not c.startswith("MONTHS_BALANCE")}
BUREAU_FILLED = spec("""
    DAYS_CREDIT: min max mean var
    CREDIT_DAY_OVERDUE: max mean
    DAYS_CREDIT_ENDDATE: min max mean
    AMT_CREDIT_MAX_OVERDUE: mean
    CNT_CREDIT_PROLONG: sum
    AMT_CREDIT_SUM: max mean sum std
    AMT_CREDIT_SUM_DEBT: max mean sum std median
    AMT_CREDIT_SUM_OVERDUE: mean
    AMT_CREDIT_SUM_LIMIT: mean sum
    DAYS_CREDIT_UPDATE: min max mean
    AMT_ANNUITY: max mean
    MONTHS_BALANCE_MIN: min
    MONTHS_BALANCE_MAX: max
    MONTHS_BALANCE_SIZE: mean sum
""")
DELINQUENCY_PER_CREDIT = spec("""
    MONTHS_BALANCE: max
    NEW_BUREAU_BALANCE_DPD_LEVEL: sum mean max std skew
    NEW_BUREAU_BALANCE_STATUS_UNKNOW: sum mean
""")
BUREAU_SKEW = spec("""
    DAYS_CREDIT: min max mean var sum
    DAYS_CREDIT_ENDDATE: min max mean
    DAYS_CREDIT_UPDATE: mean
    AMT_CREDIT_SUM: max mean sum
    AMT_CREDIT_SUM_DEBT: max mean sum
    AMT_CREDIT_MAX_OVERDUE: mean
    DAYS_ENDDATE_FACT: mean sum
    AMT_ANNUITY: max mean
    CNT_CREDIT_PROLONG: sum std
    MONTHS_BALANCE_MAX: max
    NEW_BUREAU_BALANCE_DPD_LEVEL_SUM: max sum
    NEW_BUREAU_BALANCE_DPD_LEVEL_MEAN: max sum mean
    NEW_BUREAU_BALANCE_DPD_LEVEL_MAX: max sum
    NEW_BUREAU_BALANCE_DPD_LEVEL_STD: max sum std
    NEW_BUREAU_BALANCE_DPD_LEVEL_SKEW: max sum skew
    NEW_BUREAU_BALANCE_STATUS_UNKNOW_SUM: max sum
    NEW_BUREAU_BALANCE_STATUS_UNKNOW_MEAN: max sum mean
    BUREAU_CREDIT_TYPE_CONSUMER: mean sum
    BUREAU_CREDIT_TYPE_CAR: mean sum
    BUREAU_CREDIT_TYPE_MORTGAGE: mean sum
    BUREAU_CREDIT_TYPE_CREDIT_CARD: mean sum
    BUREAU_CREDIT_TYPE_OTHER: mean sum
    BUREAU_UNUSUAL_CURRENCY: mean sum
    NEW_PAYMENT_RATE_SUM: max mean sum
    NEW_PAYMENT_RATE_SUM_DEBT: max mean sum
    NEW_PAYMENT_RATE_AMT_CREDIT_MAX_OVERDUE: max mean sum
""")
BUREAU_RATIOS = spec("""
    DAYS_CREDIT: min max mean
    DAYS_CREDIT_ENDDATE: min max mean
    DAYS_CREDIT_UPDATE: mean
    CREDIT_DAY_OVERDUE: max mean
    AMT_CREDIT_MAX_OVERDUE: mean
    AMT_CREDIT_SUM: max mean sum
    AMT_CREDIT_SUM_DEBT: max mean sum
    AMT_CREDIT_SUM_OVERDUE: mean
    AMT_CREDIT_SUM_LIMIT: mean sum
    AMT_ANNUITY: max mean
    CNT_CREDIT_PROLONG: sum
    MONTHS_BALANCE_MIN: min
    MONTHS_BALANCE_MAX: max
    MONTHS_BALANCE_SIZE: mean sum
    NEW_OVERDUE_TO_CREDIT_SUM_RATIO: min max mean
    NEW_OVERDUE_TO_DEBT_SUM_RATIO: min max mean
    NEW_DEBT_SUM_TO_CREDIT_SUM_RATIO: min max mean
    NEW_ANNUITY_TO_CREDIT_SUM_RATIO: min max mean
    NEW_DAYS_CREDIT_UPDATE_DIFF: min max mean
    NEW_AMT_LIMIT_RATIO: min max mean
    NEW_EARLY_PAID: mean
""")

# ---- fixed values: earlier applications --------------------------------------

PREVIOUS_DAY_COLUMNS = names("""
    DAYS_FIRST_DRAWING
    DAYS_FIRST_DUE
    DAYS_LAST_DUE_1ST_VERSION
    DAYS_LAST_DUE
    DAYS_TERMINATION
""")
WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY"]
WEEKEND = ["SATURDAY", "SUNDAY"]
WORKING_HOURS = (8, 17)
COMPANIONS = ["Family", "Spouse, partner", "Children", "Other_B", "Other_A", "Group of people"]
MINOR_GOODS = names("""
    Auto Accessories
    Jewelry
    Homewares
    Medical Supplies
    Vehicles
    Sport and Leisure
    Gardening
    Other
    Office Appliances
    Tourism
    Medicine
    Direct Sales
    Fitness
    Additional Service
    Education
    Weapon
    Insurance
    House Construction
    Animals
""")
MINOR_INDUSTRIES = ["Auto technology", "Jewelry", "MLM partners", "Tourism"]
MINOR_PURPOSES = names("""
    Buying a used car
    Building a house or an annex
    Everyday expenses
    Medicine
    Payments on other loans
    Education
    Journey
    Purchase of electronic equipment
    Buying a new car
    Wedding / gift / holiday
    Buying a home
    Car repairs
    Furniture
    Buying a holiday home / land
    Business development
    Gasification / water supply
    Buying a garage
    Hobby
    Money for a third person
    Refusal to name the goal
    Urgent needs
    Other
""")
MINOR_PAYMENT_TYPES = ["Non-cash from your account", "Cashless from the account of the employer"]
MINOR_CHANNELS = ["Channel of corporate sales", "Car dealer"]

PREVIOUS_BASE = spec("""
    AMT_ANNUITY: min max mean
    AMT_APPLICATION: min max mean
    AMT_CREDIT: min max mean
    NEW_APP_CREDIT_PERC: min max mean var
    AMT_DOWN_PAYMENT: min max mean
    AMT_GOODS_PRICE: min max mean
    HOUR_APPR_PROCESS_START: min max mean
    RATE_DOWN_PAYMENT: min max mean
    DAYS_DECISION: min max mean
    CNT_PAYMENT: mean sum
""")
PREVIOUS_REGROUPED = spec("""
    SK_ID_CURR: count
    AMT_ANNUITY: max
    AMT_APPLICATION: min mean max
    AMT_CREDIT: max
    AMT_GOODS_PRICE: sum mean
    NFLAG_LAST_APPL_IN_DAY: sum mean
    RATE_DOWN_PAYMENT: sum mean
    RATE_INTEREST_PRIMARY: sum mean
    RATE_INTEREST_PRIVILEGED: sum mean
    DAYS_DECISION: sum
    NEW_LOAN_RATE: sum mean min max
    NEW_INSURANCE: sum mean
""")
PREVIOUS_REGROUPED_DROPS = names("""
    AMT_DOWN_PAYMENT
    SELLERPLACE_AREA
    CNT_PAYMENT
    PRODUCT_COMBINATION
    DAYS_FIRST_DRAWING
    DAYS_FIRST_DUE
    DAYS_LAST_DUE_1ST_VERSION
    DAYS_LAST_DUE
    DAYS_TERMINATION
    NFLAG_INSURED_ON_APPROVAL
""")
PREVIOUS_DROP_FIRST = spec("""
    SK_ID_CURR: size
    AMT_ANNUITY: max min mean std sum
    AMT_APPLICATION: max min mean std sum
    AMT_CREDIT: max min mean std sum
    AMT_DOWN_PAYMENT: max min mean std sum
    AMT_GOODS_PRICE: max min mean std sum
    RATE_DOWN_PAYMENT: max min mean std
    DAYS_DECISION: max min mean sum
    CNT_PAYMENT: max min mean std sum
    DAYS_FIRST_DRAWING: max min mean sum
    DAYS_FIRST_DUE: max min mean sum
    DAYS_LAST_DUE_1ST_VERSION: max min mean sum
    DAYS_LAST_DUE: max min mean sum
    DAYS_TERMINATION: max min mean std sum
    NEW_RETURN_DAY: max min mean std sum
    NEW_DAYS_TERMINATION_diff: max min mean std sum
    NEW_AMT_DOWN_PAYMENT_rate: max min mean std
    NEW_AMT_SPEND_TO_PRODUCT: max min mean std sum
    NEW_APP_CREDIT_PERC: max min mean
""")
PREVIOUS_DROP_FIRST_UNUSED = names("""
    RATE_INTEREST_PRIMARY
    RATE_INTEREST_PRIVILEGED
    FLAG_LAST_APPL_PER_CONTRACT
    NFLAG_LAST_APPL_IN_DAY
    NAME_PRODUCT_TYPE
    SELLERPLACE_AREA
""")
PREVIOUS_DROP_FIRST_IGNORED = {"CODE_REJECT_REASON": ["SYSTEM"]}
PREVIOUS_OUTLIER_COLUMNS = names("""
    AMT_ANNUITY
    AMT_APPLICATION
    AMT_CREDIT
    AMT_DOWN_PAYMENT
    AMT_GOODS_PRICE
    SELLERPLACE_AREA
""")
LOW_VARIANCE = 0.1
LAST_REQUIRED = names("""
    NAME_CONTRACT_TYPE
    APPROVED_CREDIT/TOTAL_CREDIT
    NAME_CLIENT_TYPE
    PRODUCT_COMBINATION
    CHANNEL_TYPE
""")
LAST_RARE_PERCENT = {
    "PRODUCT_COMBINATION": 1.8,
    "NAME_YIELD_GROUP": 2,
    "NAME_SELLER_INDUSTRY": 2.14,
    "NAME_GOODS_CATEGORY": 1.4,
    "CODE_REJECT_REASON": 2.5,
    "NAME_CASH_LOAN_PURPOSE": 1.5,
    "NAME_PAYMENT_TYPE": 1,
}
LAST_PAYMENT_REQUIRED = names("""
    Delaying_Number
    Paying_Rate
    AMT_PAYMENT
    DAYS_ENTRY_PAYMENT
    DAYS_INSTALMENT
    NUM_INSTALMENT_NUMBER
    NUM_INSTALMENT_VERSION
""")
LAST_NOMINAL = names("""
    FLAG_LAST_APPL_PER_CONTRACT
    NAME_CASH_LOAN_PURPOSE
    NAME_SELLER_INDUSTRY
    PRODUCT_COMBINATION
    WEEKDAY_APPR_PROCESS_START
    CHANNEL_TYPE
    NAME_GOODS_CATEGORY
    NAME_PORTFOLIO
    NAME_CONTRACT_TYPE
    NAME_PAYMENT_TYPE
    NAME_TYPE_SUITE
""")
LAST_ORDINAL = names("""
    STATUS_OF_LAST_APPEAL
    NAME_CONTRACT_STATUS
    NAME_YIELD_GROUP
    finished_on_time-CAT
    Delaying_Number-CAT
    started_on_time-CAT
    NAME_PRODUCT_TYPE
    CODE_REJECT_REASON
    NAME_CLIENT_TYPE
""")

# ---- fixed values: loan balances and instalments -----------------------------

POS_BASE = spec("""
    MONTHS_BALANCE: max mean size
    SK_DPD: max mean
    SK_DPD_DEF: max mean
""")
POS_FLAT = spec("""
    SK_ID_PREV: min max mean count
    MONTHS_BALANCE: min max
    CNT_INSTALMENT: min max mean
    CNT_INSTALMENT_FUTURE: min max mean
    SK_DPD: max mean
    SK_DPD_DEF: max mean
""")
POS_PER_LOAN = spec("""
    MONTHS_BALANCE: min max
    CNT_INSTALMENT: min max
    CNT_INSTALMENT_FUTURE: min max
    SK_DPD: max mean
    SK_DPD_DEF: max mean
""")
POS_PER_LOAN_STATUSES = ["Active", "Completed", "Demand"]
MINOR_POS_STATUSES = ["Demand", "Returned to the store", "Approved", "Amortized debt", "Canceled", "XNA"]
POS_LEVEL_ONE = spec("""
    MONTHS_BALANCE: max min
    SK_DPD: max mean std
    SK_DPD_DEF: max mean std
    CNT_INSTALMENT: min mean max
    CNT_INSTALMENT_FUTURE: mean min max
    SK_ID_CURR: max size
    NEW_ADJOURNMENT: max mean std
""")
POS_LEVEL_ONE_STATUSES = ["Active", "Completed", "Signed", "Others"]
POS_LEVEL_TWO = spec("""
    MONTHS_BALANCE_MAX: min max mean
    MONTHS_BALANCE_MIN: min max mean
    SK_DPD_MAX: max mean min
    SK_DPD_MEAN: max mean min
    SK_DPD_STD: max mean min std
    SK_DPD_DEF_MAX: max mean min
    SK_DPD_DEF_MEAN: max mean min
    SK_DPD_DEF_STD: max mean min
    CNT_INSTALMENT_MIN: max mean min
    CNT_INSTALMENT_MEAN: max mean min
    CNT_INSTALMENT_MAX: max mean min
    CNT_INSTALMENT_FUTURE_MEAN: max mean min
    CNT_INSTALMENT_FUTURE_MIN: max mean min
    CNT_INSTALMENT_FUTURE_MAX: max mean min
    SK_ID_CURR_MAX: max min
    SK_ID_CURR_SIZE: max min
    NEW_ADJOURNMENT_MAX: max mean min
    NEW_ADJOURNMENT_MEAN: max mean min
    NEW_ADJOURNMENT_STD: max mean min
    NAME_CONTRACT_STATUS_Active_SUM: max min sum
    NAME_CONTRACT_STATUS_Signed_SUM: max min sum
    NAME_CONTRACT_STATUS_Completed_SUM: max min sum
    NAME_CONTRACT_STATUS_Others_SUM: max min sum
""")
INSTALMENT_BASE = spec("""
    NUM_INSTALMENT_VERSION: nunique
    NEW_DPD: max mean sum
    NEW_DBD: max mean sum
    NEW_PAYMENT_PERC: max mean sum var
    NEW_PAYMENT_DIFF: max mean sum var
    AMT_INSTALMENT: max mean sum
    AMT_PAYMENT: min max mean sum
    DAYS_ENTRY_PAYMENT: max mean sum
""")
INSTALMENT_PER_LOAN = spec("""
    NUM_INSTALMENT_VERSION: nunique
    NUM_INSTALMENT_NUMBER: max
    AMT_INSTALMENT: min max sum mean
    AMT_PAYMENT: min max sum mean
    NEW_DAYS_PAID_EARLIER: mean
    NEW_NUM_PAID_LATER: sum
""")
INSTALMENT_VERSIONS = [1.0, 2.0, 3.0, 4.0]
INSTALMENT_LEVEL_ONE = spec("""
    SK_ID_CURR: count max
    NEW_DELAY: max min mean std sum
    NUM_INSTALMENT_NUMBER: min max
    DAYS_INSTALMENT: max min std
    NEW_PAYMENT_DIFF: max mean std min sum
    AMT_INSTALMENT: max mean sum min std
    AMT_PAYMENT: min max mean sum std
    DAYS_ENTRY_PAYMENT: max min std
""")
INSTALMENT_LEVEL_TWO = spec("""
    SK_ID_CURR_COUNT: min max
    SK_ID_CURR_MAX: min max
    NEW_DELAY_MAX: min max mean
    NEW_DELAY_MIN: min max mean
    NEW_DELAY_MEAN: min max mean
    NEW_DELAY_STD: min max mean
    NEW_DELAY_SUM: min max mean sum std
    NUM_INSTALMENT_NUMBER_MIN: min max mean
    NUM_INSTALMENT_NUMBER_MAX: min max mean sum
    NEW_DAYS_INSTALMENT_NUMBER: min max std
    DAYS_INSTALMENT_STD: min max std
    DAYS_INSTALMENT_MIN: std min max
    DAYS_INSTALMENT_MAX: std min max
    NEW_PAYMENT_DIFF_MAX: min max mean std
    NEW_PAYMENT_DIFF_MEAN: min max mean std
    NEW_PAYMENT_DIFF_SUM: min max mean std
    NEW_PAYMENT_DIFF_STD: min max mean std
    NEW_PAYMENT_DIFF_MIN: min max mean std
    AMT_INSTALMENT_MAX: min max mean sum
    AMT_INSTALMENT_MEAN: min max mean sum
    AMT_INSTALMENT_SUM: min max mean sum
    AMT_INSTALMENT_STD: min max mean sum
    AMT_INSTALMENT_MIN: min max mean sum
    NEW_AMT_INSTALMENT_DIFF: min max mean sum
    AMT_PAYMENT_MIN: min max mean std sum
    AMT_PAYMENT_MAX: min max mean std sum
    AMT_PAYMENT_MEAN: min max mean std sum
    AMT_PAYMENT_STD: min max mean std sum
    AMT_PAYMENT_SUM: min max mean std sum
    DAYS_ENTRY_PAYMENT_MIN: min max mean
    DAYS_ENTRY_PAYMENT_STD: min max mean
    DAYS_ENTRY_PAYMENT_MAX: min max mean
    NUM_INSTALMENT_VERSION_1.0_SUM: sum
    NUM_INSTALMENT_VERSION_2.0_SUM: sum
    NUM_INSTALMENT_VERSION_3.0_SUM: sum
    NUM_INSTALMENT_VERSION_4.0_SUM: sum
""")
INSTALMENT_STATUS = spec("""
    NUM_INSTALMENT_VERSION: max
    NUM_INSTALMENT_NUMBER: max
    AMT_INSTALMENT: sum
    AMT_PAYMENT: sum
    NEW_INSTALMENT_PAYMENT_RATE: min max mean
    NEW_INS_IS_LATE: mean sum
""")
INSTALMENT_STATUS_LABELS = ["Early", "In Time", "Late", "No Payment"]

# ---- fixed values: card balances ---------------------------------------------

FIVE_FUNCTIONS = ["min", "max", "mean", "sum", "var"]
CARD_BEHAVIOUR = spec("""
    MONTHS_BALANCE: sum mean
    AMT_BALANCE: sum mean min max
    AMT_CREDIT_LIMIT_ACTUAL: sum mean
    AMT_DRAWINGS_ATM_CURRENT: sum mean min max
    AMT_DRAWINGS_CURRENT: sum mean min max
    AMT_DRAWINGS_OTHER_CURRENT: sum mean min max
    AMT_DRAWINGS_POS_CURRENT: sum mean min max
    AMT_INST_MIN_REGULARITY: sum mean min max
    AMT_PAYMENT_CURRENT: sum mean min max
    AMT_PAYMENT_TOTAL_CURRENT: sum mean min max
    AMT_RECEIVABLE_PRINCIPAL: sum mean min max
    AMT_RECIVABLE: sum mean min max
    AMT_TOTAL_RECEIVABLE: sum mean min max
    CNT_DRAWINGS_ATM_CURRENT: sum mean
    CNT_DRAWINGS_CURRENT: sum mean max
    CNT_DRAWINGS_OTHER_CURRENT: mean max
    CNT_DRAWINGS_POS_CURRENT: sum mean max
    CNT_INSTALMENT_MATURE_CUM: sum mean max min
    SK_DPD: sum mean max
    SK_DPD_DEF: sum mean max
""")
CARD_MEANS_KEPT = names("""
    CC_NEW_LOAN_TO_CREDIT_LIMIT_RATE
    CC_NEW_PAID_AMOUNT_RATE
    CC_AMT_CREDIT_LIMIT_ACTUAL_MEAN
    CC_AMT_PAYMENT_CURRENT_MEAN
    CC_MONTHS_BALANCE_MEAN
    CC_CNT_INSTALMENT_MATURE_CUM_MEAN
    CC_AMT_INST_MIN_REGULARITY_MEAN
    CC_AMT_DRAWINGS_ATM_CURRENT_MEAN
    CC_AMT_DRAWINGS_POS_CURRENT_MEAN
    CC_CNT_DRAWINGS_ATM_CURRENT_MEAN
    CC_CNT_DRAWINGS_POS_CURRENT_MEAN
    CC_NEW_AMT_PER_ATM_DRAWING_MEAN
    CC_NEW_AMT_PER_POS_DRAWING_MEAN
""")
