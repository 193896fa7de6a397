"""Sources and sinks (S1-S6): what is written comes back unchanged."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract
from ..operators import metrics as MT
from ..plans.feature_store import build_feature_store
from ..session import scratch_path
from ..sources import roles, tables
from . import query
from .common import app, rounded, with_roles
from .histories import HISTORIES
from .scores import METRICS, _rounded_metrics, scored


@query("SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def csv_round_trip(spark, sf_dir):
    orders = roles.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    path = scratch_path(spark, "orders")
    orders.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, orders.schema)


@query(f"{HISTORIES} SELECT a.SK_ID_CURR, a.TARGET, g.BUREAU_CREDIT_COUNT, p.PREV_APPLICATION_COUNT FROM application a "
       "LEFT JOIN bureau_agg g ON a.SK_ID_CURR = g.SK_ID_CURR LEFT JOIN previous_agg p ON a.SK_ID_CURR = p.SK_ID_CURR")
def store_round_trip(spark, sf_dir):
    path = scratch_path(spark, "store")
    build_feature_store(roles.loan_tables(spark, sf_dir), path)
    return tables.read_store(spark, path, ["SK_ID_CURR", "TARGET", "BUREAU_CREDIT_COUNT", "PREV_APPLICATION_COUNT"])


@query(f"{METRICS} SELECT model, {_rounded_metrics([c for c in MT.COMPARISON_COLUMNS if not c.startswith('cv_')])} FROM comparison")
def comparison_csv(spark, sf_dir):
    path = scratch_path(spark, "comparison")
    table = MT.comparison_table(MT.evaluate(scored(spark, sf_dir), "y", "yhat", "score", ["model", "split"]))
    tables.write_comparison(table, path)
    back = tables.read_csv(spark, path, table.schema)
    return rounded(back.drop("cv_mean", "cv_std"))


@query(f"{with_roles('application')}, s AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr(coalesce({c}, 0), TARGET)) AS strength FROM application" for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"))
    + ") SELECT CAST(row_number() OVER (ORDER BY strength DESC, feature) AS BIGINT) AS rank, feature FROM s")
def selected_json(spark, sf_dir):
    from ..plans.selection import select_features
    names = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
    row = app(spark, sf_dir).agg(*[F.abs(F.corr(F.coalesce(F.col(c), F.lit(0)), F.col(contract.TARGET_COLUMN))).alias(c) for c in names])
    strengths = row.unpivot([], names, "feature", "importance")
    path = scratch_path(spark, "selected")
    tables.write_selected(select_features(strengths, -1.0), path)
    return spark.read.schema("rank bigint, feature string").json(path)
