"""Row-level expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract
from ..functions import scalars as S
from ..operators.coercion import TypeCoercer
from ..operators.row_features import (AGE_EDGES, AGE_LABELS, BURDEN_EDGES, BURDEN_LABELS, EXTERNAL_SCORES, RATIOS,
                                      SQUARED, add_row_features)
from ..sources import roles
from . import query
from .common import app, rounded, rounded_sql, with_roles

APPLICATION = with_roles("application")


def years_sql(days: str) -> str:
    return f"round_even(CAST(-{days} AS DOUBLE) / 365, 1)"


def bins_sql(value: str, edges, labels) -> str:
    quote = (lambda x: f"'{x}'") if isinstance(labels[0], str) else str
    cases = " ".join(f"WHEN {value} > {a} AND {value} <= {b} THEN {quote(x)}"
                     for a, b, x in zip(edges[:-1], edges[1:], labels))
    return f"CASE {cases} END"


def ratio_sql(numerator: str, denominator: str, epsilon: float) -> str:
    return f"({numerator} / ({denominator} + CAST({epsilon} AS DOUBLE)))"


EMPLOYED = f"nullif(DAYS_EMPLOYED, {contract.EMPLOYMENT_SENTINEL})"
EMPLOYMENT = f"CASE WHEN {EMPLOYED} IS NOT NULL THEN round_even(greatest(CAST(-{EMPLOYED} AS DOUBLE) / 365, 0.0), 1) END"
KNOWN = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in EXTERNAL_SCORES)
EXT_MEAN = f"({' + '.join(f'coalesce({c}, 0.0)' for c in EXTERNAL_SCORES)}) / nullif({KNOWN}, 0)"
EXT_LIST = ", ".join(EXTERNAL_SCORES)
DOCUMENTS = ("FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_6")


def row_feature_sql(epsilon: float) -> dict[str, str]:
    """Derived feature -> SQL over the application role."""
    income = ratio_sql("AMT_CREDIT", "AMT_INCOME_TOTAL", epsilon)
    features = {
        "AGE_YEARS": years_sql("DAYS_BIRTH"),
        "AGE_GROUP": f"CAST({bins_sql(years_sql('DAYS_BIRTH'), AGE_EDGES, AGE_LABELS)} AS INT)",
        "DAYS_EMPLOYED_ANOM": f"CAST(coalesce(DAYS_EMPLOYED = {contract.EMPLOYMENT_SENTINEL}, false) AS INT)",
        "EMPLOYMENT_YEARS": EMPLOYMENT,
        "REGISTRATION_YEARS": years_sql("DAYS_REGISTRATION"),
        "ID_PUBLISH_YEARS": years_sql("DAYS_ID_PUBLISH"),
        "CREDIT_BURDEN_GROUP": bins_sql(income, BURDEN_EDGES, BURDEN_LABELS),
        "DOWN_PAYMENT_PROXY": "CASE WHEN AMT_CREDIT - AMT_GOODS_PRICE IS NOT NULL "
                              "THEN greatest(AMT_CREDIT - AMT_GOODS_PRICE, 0.0) END",
        "EXT_SOURCE_MEAN": EXT_MEAN,
        "EXT_SOURCE_MIN": f"least({EXT_LIST})",
        "EXT_SOURCE_MAX": f"greatest({EXT_LIST})",
        "EXT_SOURCE_RANGE": f"greatest({EXT_LIST}) - least({EXT_LIST})",
        "DOCUMENTS_SUBMITTED": " + ".join(f"coalesce({c}, 0)" for c in DOCUMENTS),
    }
    for name, numerator, denominator in RATIOS:
        features[name] = ratio_sql(numerator, denominator, epsilon)
    for name in SQUARED:
        features[f"{name}_SQ"] = f"({features[name]}) * ({features[name]})"
    return features


DOUBLE_FEATURES = frozenset(row_feature_sql(1.0)) - {"AGE_GROUP", "DAYS_EMPLOYED_ANOM", "CREDIT_BURDEN_GROUP",
                                                     "DOCUMENTS_SUBMITTED"}


def feature_select(names, epsilon: float) -> list[str]:
    features = row_feature_sql(epsilon)
    return [rounded_sql(features[n], n) if n in DOUBLE_FEATURES else f"{features[n]} AS {n}" for n in names]


def _only(names, epsilon: float = contract.ROW_EPSILON) -> str:
    return f"{APPLICATION} SELECT SK_ID_CURR, {', '.join(feature_select(names, epsilon))} FROM application"


YEARS = ("AGE_YEARS", "REGISTRATION_YEARS", "ID_PUBLISH_YEARS")


@query(_only(YEARS))
def days_to_years(spark, sf_dir):
    days = {"AGE_YEARS": "DAYS_BIRTH", "REGISTRATION_YEARS": "DAYS_REGISTRATION", "ID_PUBLISH_YEARS": "DAYS_ID_PUBLISH"}
    return rounded(app(spark, sf_dir).select("SK_ID_CURR", *[S.days_to_years(d).alias(n) for n, d in days.items()]))


@query(_only(("AGE_GROUP", "CREDIT_BURDEN_GROUP")))
def fixed_bins(spark, sf_dir):
    ratio = S.epsilon_ratio("AMT_CREDIT", "AMT_INCOME_TOTAL", contract.ROW_EPSILON)
    return app(spark, sf_dir).select(
        "SK_ID_CURR", S.fixed_bins(S.days_to_years("DAYS_BIRTH"), AGE_EDGES, AGE_LABELS).alias("AGE_GROUP"),
        S.fixed_bins(ratio, BURDEN_EDGES, BURDEN_LABELS).alias("CREDIT_BURDEN_GROUP"))


@query(f"{APPLICATION} SELECT SK_ID_CURR, {EMPLOYED} AS DAYS_EMPLOYED, "
       f"{', '.join(feature_select(('DAYS_EMPLOYED_ANOM', 'EMPLOYMENT_YEARS'), 1.0))} FROM application")
def sentinel_flag_null(spark, sf_dir):
    kept = S.sentinel_to_null("DAYS_EMPLOYED", contract.EMPLOYMENT_SENTINEL)
    return rounded(app(spark, sf_dir).select(
        "SK_ID_CURR", kept.alias("DAYS_EMPLOYED"),
        S.sentinel_flag("DAYS_EMPLOYED", contract.EMPLOYMENT_SENTINEL).alias("DAYS_EMPLOYED_ANOM"),
        S.years_with_floor(kept).alias("EMPLOYMENT_YEARS")))


@query(_only([r[0] for r in RATIOS]))
def ratios_eps(spark, sf_dir):
    return rounded(app(spark, sf_dir).select(
        "SK_ID_CURR", *[S.epsilon_ratio(n, d, contract.ROW_EPSILON).alias(o) for o, n, d in RATIOS]))


@query(_only(("DOWN_PAYMENT_PROXY",)))
def non_negative_difference(spark, sf_dir):
    return rounded(app(spark, sf_dir).select(
        "SK_ID_CURR", S.non_negative_difference("AMT_CREDIT", "AMT_GOODS_PRICE").alias("DOWN_PAYMENT_PROXY")))


EXT_STATS = ("EXT_SOURCE_MEAN", "EXT_SOURCE_MIN", "EXT_SOURCE_MAX", "EXT_SOURCE_RANGE")


@query(_only(EXT_STATS))
def row_stats(spark, sf_dir):
    builders = (S.row_mean, S.row_min, S.row_max, S.row_range)
    return rounded(app(spark, sf_dir).select(
        "SK_ID_CURR", *[b(EXTERNAL_SCORES).alias(n) for n, b in zip(EXT_STATS, builders)]))


@query(_only(("DOCUMENTS_SUBMITTED",)))
def prefix_sum(spark, sf_dir):
    df = app(spark, sf_dir)
    return df.select("SK_ID_CURR", S.row_sum(S.prefix_columns(df.columns, "FLAG_DOCUMENT_")).alias("DOCUMENTS_SUBMITTED"))


@query(_only([f"{n}_SQ" for n in SQUARED]))
def squares(spark, sf_dir):
    df = add_row_features(app(spark, sf_dir))
    return rounded(df.select("SK_ID_CURR", *[S.square(n).alias(f"{n}_SQ") for n in SQUARED]))


RAW_COLUMNS = list(roles.APPLICATION)
ALL_ROW_FEATURES = (
    f"{APPLICATION} SELECT {', '.join(f'{EMPLOYED} AS DAYS_EMPLOYED' if c == 'DAYS_EMPLOYED' else c for c in RAW_COLUMNS)}, "
    f"{', '.join(feature_select(row_feature_sql(contract.STORE_EPSILON), contract.STORE_EPSILON))} FROM application"
)


@query(ALL_ROW_FEATURES)
def row_features_all(spark, sf_dir):
    return rounded(add_row_features(app(spark, sf_dir), epsilon=contract.STORE_EPSILON))


MESSY_NUMBER = ("CASE o_orderkey % 8 WHEN 0 THEN o_orderpriority WHEN 1 THEN concat(' ', CAST(o_orderkey AS VARCHAR(20)), ' ') "
                "WHEN 2 THEN concat(CAST(o_orderkey AS VARCHAR(20)), 'd') WHEN 3 THEN concat(CAST(o_orderkey AS VARCHAR(20)), 'e2') "
                "WHEN 4 THEN '' WHEN 5 THEN concat('-.', CAST(o_orderkey AS VARCHAR(20))) WHEN 6 THEN NULL "
                "ELSE CAST(o_orderkey AS VARCHAR(20)) END")
NUMBER_REGEX = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)\s*$"


@query(f"WITH t AS (SELECT o_orderkey, {MESSY_NUMBER} AS raw FROM orders) SELECT o_orderkey, "
       f"CASE WHEN regexp_matches(raw, '{NUMBER_REGEX}') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS amount FROM t")
def coerce_numeric(spark, sf_dir):
    raw = roles.read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{MESSY_NUMBER} AS raw")
    return raw.select("o_orderkey", S.to_number("raw").alias("amount"))


MIXED_FLAG = ("CASE SK_ID_CURR % 5 WHEN 0 THEN lower(FLAG_OWN_CAR) WHEN 1 THEN NULL WHEN 2 THEN 'XNA' ELSE FLAG_OWN_CAR END")


@query(f"{APPLICATION}, t AS (SELECT SK_ID_CURR, {MIXED_FLAG} AS flag, CODE_GENDER FROM application) "
       "SELECT SK_ID_CURR, CASE WHEN upper(flag) = 'Y' THEN '1' WHEN upper(flag) = 'N' THEN '0' ELSE flag END AS flag, "
       "CODE_GENDER FROM t")
def yes_no(spark, sf_dir):
    df = app(spark, sf_dir).selectExpr("SK_ID_CURR", f"{MIXED_FLAG} AS flag", "CODE_GENDER")
    return TypeCoercer().fit(df).transform(df)


@query(f"{APPLICATION} SELECT SK_ID_CURR, EXT_SOURCE_2 AS probability, "
       f"CAST(EXT_SOURCE_2 >= {contract.DEFAULT_THRESHOLD} AS INT) AS prediction FROM application")
def threshold_predicate(spark, sf_dir):
    return app(spark, sf_dir).select("SK_ID_CURR", F.col("EXT_SOURCE_2").alias("probability"),
                                     S.at_or_above("EXT_SOURCE_2", contract.DEFAULT_THRESHOLD).alias("prediction"))


@query(f"{APPLICATION} SELECT SK_ID_CURR, coalesce(NAME_EDUCATION_TYPE, 'missing') AS NAME_EDUCATION_TYPE, "
       "CODE_GENDER FROM application")
def const_impute(spark, sf_dir):
    from ..operators.encoders import ConstantImputer
    df = app(spark, sf_dir).select("SK_ID_CURR", "NAME_EDUCATION_TYPE", "CODE_GENDER")
    return ConstantImputer(inputCols=["NAME_EDUCATION_TYPE", "CODE_GENDER"], label="missing").transform(df)


@query(f"{APPLICATION} SELECT AMT_CREDIT, CODE_GENDER FROM application")
def drop_control_columns(spark, sf_dir):
    df = app(spark, sf_dir).select("SK_ID_CURR", "TARGET", "AMT_CREDIT", "CODE_GENDER")
    return df.drop(contract.ID_COLUMN, contract.TARGET_COLUMN, "NOT_THERE")
