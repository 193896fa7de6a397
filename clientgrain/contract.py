"""The published feature contract: names and constants that results depend on."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
ID_COLUMN = "SK_ID_CURR"
TARGET_COLUMN = "TARGET"
CREDIT_ID = "SK_ID_BUREAU"
PREVIOUS_ID = "SK_ID_PREV"

SEED = 42
TEST_SIZE = 0.25
QUICK_TEST_SIZE = 0.2
CV_FOLDS = 5
POSITIVE_WEIGHT = 15.0
DEFAULT_THRESHOLD = 0.42
IMPORTANCE_THRESHOLD = 0.0004
EMPLOYMENT_SENTINEL = 365243
STORE_EPSILON = 1e-3
ROW_EPSILON = 1e-5

STATUSES = ("0", "1", "2", "3", "4", "5", "C", "X")

BUREAU_NUMERIC = (
    "AMT_ANNUITY", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT",
    "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "CNT_CREDIT_PROLONG",
    "CREDIT_DAY_OVERDUE", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_UPDATE",
    "DAYS_ENDDATE_FACT",
)

PREVIOUS_NUMERIC = (
    "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
    "CNT_PAYMENT", "DAYS_DECISION", "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION", "DAYS_TERMINATION", "HOUR_APPR_PROCESS_START",
    "NFLAG_INSURED_ON_APPROVAL", "NFLAG_LAST_APPL_IN_DAY", "RATE_DOWN_PAYMENT",
    "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "SELLERPLACE_AREA",
)

# Columns of the application table, as published.
APPLICATION_NUMERIC = (
    "AMT_ANNUITY", "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL", "AMT_REQ_CREDIT_BUREAU_DAY", "AMT_REQ_CREDIT_BUREAU_HOUR",
    "AMT_REQ_CREDIT_BUREAU_MON", "AMT_REQ_CREDIT_BUREAU_QRT", "AMT_REQ_CREDIT_BUREAU_WEEK", "AMT_REQ_CREDIT_BUREAU_YEAR",
    "APARTMENTS_AVG", "APARTMENTS_MEDI", "APARTMENTS_MODE", "BASEMENTAREA_AVG", "BASEMENTAREA_MEDI", "BASEMENTAREA_MODE",
    "CNT_CHILDREN", "CNT_FAM_MEMBERS", "COMMONAREA_AVG", "COMMONAREA_MEDI", "COMMONAREA_MODE", "DAYS_BIRTH", "DAYS_EMPLOYED",
    "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE", "DAYS_REGISTRATION", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE",
    "ELEVATORS_AVG", "ELEVATORS_MEDI", "ELEVATORS_MODE", "ENTRANCES_AVG", "ENTRANCES_MEDI", "ENTRANCES_MODE", "EXT_SOURCE_1",
    "EXT_SOURCE_2", "EXT_SOURCE_3", "FLOORSMAX_AVG", "FLOORSMAX_MEDI", "FLOORSMAX_MODE", "FLOORSMIN_AVG", "FLOORSMIN_MEDI",
    "FLOORSMIN_MODE", "HOUR_APPR_PROCESS_START", "LANDAREA_AVG", "LANDAREA_MEDI", "LANDAREA_MODE", "LIVINGAPARTMENTS_AVG",
    "LIVINGAPARTMENTS_MEDI", "LIVINGAPARTMENTS_MODE", "LIVINGAREA_AVG", "LIVINGAREA_MEDI", "LIVINGAREA_MODE",
    "NONLIVINGAPARTMENTS_AVG", "NONLIVINGAPARTMENTS_MEDI", "NONLIVINGAPARTMENTS_MODE", "NONLIVINGAREA_AVG", "NONLIVINGAREA_MEDI",
    "NONLIVINGAREA_MODE", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", "OWN_CAR_AGE", "REGION_POPULATION_RELATIVE",
    "REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY", "TOTALAREA_MODE", "YEARS_BEGINEXPLUATATION_AVG",
    "YEARS_BEGINEXPLUATATION_MEDI", "YEARS_BEGINEXPLUATATION_MODE", "YEARS_BUILD_AVG", "YEARS_BUILD_MEDI", "YEARS_BUILD_MODE",
)

DERIVED_NUMERIC = (
    "AGE_GROUP", "AGE_YEARS", "AGE_YEARS_SQ", "ANNUITY_CREDIT_RATIO", "ANNUITY_INCOME_RATIO",
    "ANNUITY_INCOME_RATIO_SQ", "CREDIT_INCOME_RATIO", "CREDIT_INCOME_RATIO_SQ",
    "CREDIT_TERM_EST", "DAYS_EMPLOYED_ANOM", "DOCUMENTS_SUBMITTED", "DOWN_PAYMENT_PROXY",
    "EMPLOYMENT_YEARS", "EMPLOYMENT_YEARS_SQ", "EXT_SOURCE_MAX", "EXT_SOURCE_MEAN",
    "EXT_SOURCE_MIN", "EXT_SOURCE_RANGE", "GOODS_PRICE_CREDIT_RATIO", "ID_PUBLISH_YEARS",
    "INCOME_PER_PERSON", "REGISTRATION_YEARS",
)

CATEGORICAL_FEATURES = (
    "CODE_GENDER", "EMERGENCYSTATE_MODE", "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
    "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "NAME_CONTRACT_TYPE", "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "NAME_TYPE_SUITE",
    "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "WALLSMATERIAL_MODE",
    "WEEKDAY_APPR_PROCESS_START", "CREDIT_BURDEN_GROUP",
)

BINARY_FEATURES = (
    "FLAG_CONT_MOBILE", "FLAG_DOCUMENT_10", "FLAG_DOCUMENT_11", "FLAG_DOCUMENT_12", "FLAG_DOCUMENT_13", "FLAG_DOCUMENT_14",
    "FLAG_DOCUMENT_15", "FLAG_DOCUMENT_16", "FLAG_DOCUMENT_17", "FLAG_DOCUMENT_18", "FLAG_DOCUMENT_19", "FLAG_DOCUMENT_2",
    "FLAG_DOCUMENT_20", "FLAG_DOCUMENT_21", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_5", "FLAG_DOCUMENT_6",
    "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_8", "FLAG_DOCUMENT_9", "FLAG_EMAIL", "FLAG_EMP_PHONE", "FLAG_MOBIL", "FLAG_PHONE",
    "FLAG_WORK_PHONE", "LIVE_CITY_NOT_WORK_CITY", "LIVE_REGION_NOT_WORK_REGION", "PREV_NFLAG_INSURED_ON_APPROVAL_MAX",
    "PREV_NFLAG_INSURED_ON_APPROVAL_MIN", "PREV_NFLAG_LAST_APPL_IN_DAY_MAX", "PREV_NFLAG_LAST_APPL_IN_DAY_MIN",
    "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION",
)
# --- end of fixed values ----------------------------------------------------


def binary_features() -> list[str]:
    return list(BINARY_FEATURES)


def bureau_features() -> list[str]:
    """148 names: 21 columns times 7 statistics, and the credit count."""
    from .functions.stats import SEVEN_STATS, stat_name
    inputs = [*BUREAU_NUMERIC, *(f"BB_STATUS_PCT_{s}" for s in STATUSES), "BB_HISTORY_LENGTH"]
    return [stat_name("BUREAU", c, s) for c in inputs for s in SEVEN_STATS] + ["BUREAU_CREDIT_COUNT"]


def previous_features() -> list[str]:
    """77 names: 19 columns times 4 statistics, and the application count."""
    from .functions.stats import FOUR_STATS, stat_name
    return [stat_name("PREV", c, s) for c in PREVIOUS_NUMERIC for s in FOUR_STATS] + ["PREV_APPLICATION_COUNT"]


def numerical_features() -> list[str]:
    """The published order: columns and four statistics of each history by name, then what was added later by name."""
    flags = set(BINARY_FEATURES)
    later = [n for n in bureau_features() if n.endswith(("_STD", "__Q25", "__Q75"))]
    first = [*APPLICATION_NUMERIC, *(n for n in bureau_features() if n not in set(later)), *previous_features()]
    return [*sorted(n for n in first if n not in flags), *sorted([*later, *DERIVED_NUMERIC])]


def categorical_features() -> list[str]:
    return list(CATEGORICAL_FEATURES)


def contract_names() -> list[str]:
    return [*numerical_features(), *categorical_features(), *binary_features()]
