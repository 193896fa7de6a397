"""Profiles of raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract
from ..operators import profile as PR
from ..sources import roles
from . import query
from .common import app, rounded, with_roles

APPLICATION = with_roles("application")
COLUMNS = list(roles.APPLICATION)
TEXT = ["CODE_GENDER", "FLAG_OWN_CAR", "NAME_EDUCATION_TYPE"]
NUMBERS = [c for c in COLUMNS if c not in (*TEXT, "SK_ID_CURR", "TARGET")]
ITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(APPLICATION + " " + union(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_share FROM application" for c in COLUMNS))
def missing_share(spark, sf_dir):
    return rounded(PR.missing_share(app(spark, sf_dir)))


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(union(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in LINE_COLUMNS))
def distinct_counts(spark, sf_dir):
    return PR.distinct_counts(roles.read(spark, sf_dir, "lineitem"))


@query("SELECT * FROM (" + union(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in LINE_COLUMNS)
       + ") WHERE n_distinct > 50")
def many_valued_columns(spark, sf_dir):
    return PR.many_values(PR.distinct_counts(roles.read(spark, sf_dir, "lineitem")))


@query(APPLICATION + " SELECT * FROM (" + union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM application" for c in COLUMNS) + ") WHERE n_distinct <= 5")
def few_valued_columns(spark, sf_dir):
    return PR.few_values(PR.distinct_counts(app(spark, sf_dir)))


def summary_sql(table: str, c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS median, "
            f"round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max, round(skewness({c}), 3) AS skew FROM {table}")


def _digits(df, digits, skip=("column", "count", "min", "max")):
    return df.select(*[c if c in skip else F.round(c, digits.get(c, 4)).alias(c) for c in df.columns])


@query(APPLICATION + " " + union(summary_sql("application", c) for c in NUMBERS))
def numeric_summary(spark, sf_dir):
    return _digits(PR.numeric_summary(app(spark, sf_dir), NUMBERS), {"skew": 3})


@query(union(summary_sql("lineitem", c) for c in ITEM_NUMBERS))
def numeric_summary_bracketed(spark, sf_dir):
    """The same statistics by the search meant for columns too large for one task."""
    items = roles.read(spark, sf_dir, "lineitem")
    return _digits(PR.numeric_summary(items, ITEM_NUMBERS, group_rows=1_000, single_pass_rows=100), {"skew": 3})


AGES = f"{APPLICATION}, t AS (SELECT CAST(trunc(CAST(-DAYS_BIRTH AS DOUBLE) / 365) AS DOUBLE) AS v, TARGET FROM application)"


@query(f"{AGES}, m AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10 AS step FROM t), "
       f"b AS (SELECT {' + '.join(f'CAST(v > lo + {i} * step AS INT)' for i in range(1, 10))} AS bin, TARGET, lo, hi, step FROM t, m) "
       "SELECT bin, round(CASE WHEN bin = 0 THEN lo - (hi - lo) * 0.001 ELSE lo + bin * step END, 6) AS low, "
       "round(CASE WHEN bin = 9 THEN hi ELSE lo + (bin + 1) * step END, 6) AS high, count(*) AS n, round(avg(TARGET), 6) AS rate "
       "FROM b GROUP BY bin, lo, hi, step")
def binned_rate(spark, sf_dir):
    return rounded(PR.binned_rate(app(spark, sf_dir), PR.age_in_whole_years(), "TARGET"))


@query(f"{APPLICATION} SELECT count(*) FILTER (WHERE DAYS_EMPLOYED > 0) AS positive, "
       f"count(*) FILTER (WHERE DAYS_EMPLOYED = {contract.EMPLOYMENT_SENTINEL}) AS sentinel FROM application")
def conditional_counts(spark, sf_dir):
    days = F.col("DAYS_EMPLOYED")
    return PR.conditional_counts(app(spark, sf_dir), {"positive": days > 0, "sentinel": days == contract.EMPLOYMENT_SENTINEL})


@query(APPLICATION + " " + union(
    f"SELECT '{c}' AS \"column\", " + (f"count({c}) = 0" if c in TEXT else f"coalesce(bool_and({c} IN (0, 1)), true)")
    + " AS is_binary FROM application" for c in COLUMNS))
def binary_columns(spark, sf_dir):
    return PR.binary_columns(app(spark, sf_dir))


AMOUNTS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"]


@query(APPLICATION + " " + union(
    f"SELECT '{c}' AS \"column\", round(min({c}), 6) AS min, round(quantile_cont({c}, 0.01), 6) AS q01, "
    f"round(quantile_cont({c}, 0.99), 6) AS q99, round(max({c}), 6) AS max FROM application" for c in AMOUNTS))
def tail_quantiles(spark, sf_dir):
    return rounded(PR.tail_quantiles(app(spark, sf_dir), AMOUNTS))


@query("SELECT event_type AS \"value\", count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(event_type) FROM events), 6) AS share "
       "FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def value_shares(spark, sf_dir):
    return rounded(PR.value_shares(roles.read(spark, sf_dir, "events"), "event_type"))


@query(f"{APPLICATION} SELECT count(*) AS n_rows, CAST({len(COLUMNS)} AS INT) AS n_columns, round(avg(TARGET), 6) AS positive_rate FROM application")
def table_shape(spark, sf_dir):
    return rounded(PR.table_shape(app(spark, sf_dir), "TARGET"))


@query(APPLICATION + " SELECT * FROM (" + union(
    f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_share FROM application" for c in COLUMNS)
    + ") ORDER BY missing_share DESC, \"column\" LIMIT 5")
def top_missing(spark, sf_dir):
    return rounded(PR.top(PR.missing_share(app(spark, sf_dir)), 5, F.desc("missing_share"), "column"))
