"""History aggregates, joins and the feature store."""

from __future__ import annotations

from .. import contract
from ..functions import stats as ST
from ..operators import history as H
from ..plans.feature_store import build_feature_store
from ..sources import roles
from . import query
from .common import SHARE_DIGITS, rounded, rounded_sql, with_roles
from .features import EMPLOYED, RAW_COLUMNS, feature_select, row_feature_sql

STAT_SQL = {
    "MEAN": "avg({c})", "MAX": "max({c})", "MIN": "min({c})", "SUM": "coalesce(sum({c}), 0)",
    "STD": "stddev_samp({c})", "_Q25": "quantile_cont({c}, 0.25)", "_Q75": "quantile_cont({c}, 0.75)",
}
SHARE_COLUMNS = [f"BB_STATUS_PCT_{s}" for s in contract.STATUSES]
BUREAU_COLUMNS = ["AMT_CREDIT_SUM", "AMT_ANNUITY", *SHARE_COLUMNS, "BB_HISTORY_LENGTH"]
WHOLE_NUMBERS = {"BB_HISTORY_LENGTH", "DAYS_DECISION"}


def shares_sql(digits: bool) -> str:
    def share(status: str) -> str:
        e = f"CAST(count(*) FILTER (WHERE STATUS = '{status}') AS DOUBLE) / count(STATUS)"
        return f"round({e}, {SHARE_DIGITS})" if digits else e
    columns = ", ".join(f"{share(s)} AS BB_STATUS_PCT_{s}" for s in contract.STATUSES)
    return (f"SELECT SK_ID_BUREAU, {columns}, count(*) AS BB_HISTORY_LENGTH FROM bureau_balance "
            "WHERE SK_ID_BUREAU IS NOT NULL GROUP BY SK_ID_BUREAU HAVING count(STATUS) > 0")


def stat_select(prefix: str, columns, stats) -> list[str]:
    parts = []
    for c in columns:
        for s in stats:
            name = ST.stat_name(prefix, c, s)
            e = STAT_SQL[s].format(c=c)
            if c in WHOLE_NUMBERS and s in ("MAX", "MIN", "SUM"):
                parts.append(f"CAST({e} AS BIGINT) AS {name}")
            else:
                parts.append(rounded_sql(f"CAST({e} AS DOUBLE)", name))
    return parts


WIDE = "wide AS (SELECT b.*, s.* EXCLUDE (SK_ID_BUREAU) FROM bureau b LEFT JOIN shares s ON b.SK_ID_BUREAU = s.SK_ID_BUREAU)"
BUREAU_AGG = (f"SELECT SK_ID_CURR, {', '.join(stat_select('BUREAU', BUREAU_COLUMNS, ST.SEVEN_STATS))}, "
              "count(SK_ID_BUREAU) AS BUREAU_CREDIT_COUNT FROM wide WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR")
PREVIOUS_AGG = (f"SELECT SK_ID_CURR, {', '.join(stat_select('PREV', ['AMT_APPLICATION', 'DAYS_DECISION'], ST.FOUR_STATS))}, "
                "count(SK_ID_PREV) AS PREV_APPLICATION_COUNT FROM previous_application "
                "WHERE SK_ID_CURR IS NOT NULL GROUP BY SK_ID_CURR")
HISTORIES = (with_roles("application", "bureau", "bureau_balance", "previous_application")
             + f", shares AS ({shares_sql(False)}), {WIDE}, bureau_agg AS ({BUREAU_AGG}), previous_agg AS ({PREVIOUS_AGG})")


@query(f"{with_roles('bureau_balance')} {shares_sql(True)}")
def status_shares(spark, sf_dir):
    return rounded(H.status_shares(roles.role_table(spark, sf_dir, "bureau_balance")))


@query(f"{with_roles('bureau', 'bureau_balance')}, shares AS ({shares_sql(True)}) "
       "SELECT b.*, s.* EXCLUDE (SK_ID_BUREAU) FROM bureau b LEFT JOIN shares s ON b.SK_ID_BUREAU = s.SK_ID_BUREAU")
def left_join_shares(spark, sf_dir):
    shares = H.status_shares(roles.role_table(spark, sf_dir, "bureau_balance"))
    return rounded(roles.role_table(spark, sf_dir, "bureau").join(shares, contract.CREDIT_ID, "left"))


@query(f"{HISTORIES} SELECT * FROM bureau_agg")
def wide_agg_7(spark, sf_dir):
    shares = H.status_shares(roles.role_table(spark, sf_dir, "bureau_balance"))
    return rounded(H.bureau_aggregate(roles.role_table(spark, sf_dir, "bureau"), shares))


@query(f"{HISTORIES} SELECT * FROM bureau_agg")
def wide_agg_7_hot_keys(spark, sf_dir):
    """The same result when every client with more than ten credits counts as hot."""
    shares = H.status_shares(roles.role_table(spark, sf_dir, "bureau_balance"))
    return rounded(H.bureau_aggregate(roles.role_table(spark, sf_dir, "bureau"), shares, group_rows=10))


@query(f"{HISTORIES} SELECT * FROM previous_agg")
def wide_agg_4(spark, sf_dir):
    return rounded(H.previous_aggregate(roles.role_table(spark, sf_dir, "previous_application")))


@query(f"{HISTORIES} SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS BUREAU_CREDIT_COUNT FROM bureau GROUP BY SK_ID_CURR")
def child_counts(spark, sf_dir):
    return H.wide_aggregate(roles.role_table(spark, sf_dir, "bureau"), contract.ID_COLUMN, contract.CREDIT_ID, (),
                            "BUREAU", "BUREAU_CREDIT_COUNT")


CORE_FEATURES = ("AGE_YEARS", "CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO")


@query(f"{HISTORIES} SELECT a.SK_ID_CURR, a.TARGET, {', '.join(feature_select(CORE_FEATURES, contract.STORE_EPSILON))}, "
       "g.* EXCLUDE (SK_ID_CURR) FROM application a LEFT JOIN bureau_agg g ON a.SK_ID_CURR = g.SK_ID_CURR")
def feature_store_core(spark, sf_dir):
    tables = roles.loan_tables(spark, sf_dir)
    del tables["previous_application"]
    store = build_feature_store(tables)
    return rounded(store.select("SK_ID_CURR", "TARGET", *CORE_FEATURES,
                                *[c for c in store.columns if c.startswith("BUREAU_")]))


FULL_STORE = (
    f"{HISTORIES} SELECT {', '.join(f'{EMPLOYED} AS DAYS_EMPLOYED' if c == 'DAYS_EMPLOYED' else f'a.{c}' for c in RAW_COLUMNS)}, "
    f"{', '.join(feature_select(row_feature_sql(contract.STORE_EPSILON), contract.STORE_EPSILON))}, "
    "g.* EXCLUDE (SK_ID_CURR), p.* EXCLUDE (SK_ID_CURR) FROM application a "
    "LEFT JOIN bureau_agg g ON a.SK_ID_CURR = g.SK_ID_CURR LEFT JOIN previous_agg p ON a.SK_ID_CURR = p.SK_ID_CURR"
)


def store_columns() -> list[str]:
    """The columns FULL_STORE gives."""
    bureau = [ST.stat_name("BUREAU", c, s) for c in BUREAU_COLUMNS for s in ST.SEVEN_STATS]
    previous = [ST.stat_name("PREV", c, s) for c in ("AMT_APPLICATION", "DAYS_DECISION") for s in ST.FOUR_STATS]
    return [*RAW_COLUMNS, *row_feature_sql(contract.STORE_EPSILON), *bureau, "BUREAU_CREDIT_COUNT", *previous, "PREV_APPLICATION_COUNT"]


@query(FULL_STORE)
def feature_store_full(spark, sf_dir):
    return rounded(build_feature_store(roles.loan_tables(spark, sf_dir)))
