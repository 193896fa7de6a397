"""Scoring on streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract
from ..operators.history import HistoryAggregator, join_histories
from ..operators.row_features import add_row_features
from ..plans.scoring import check_records, score
from ..session import scratch_path
from ..sources import roles
from ..streaming.batches import split_stream
from ..streaming.scoring import application_stream, run_available
from . import query
from .common import rounded, with_roles
from .histories import FULL_STORE
from .models import SCORE_SQL, checked_scores, saved_model, stored_aggregates


def _applications(spark, sf_dir):
    schema = roles.read(spark, sf_dir, "customer").schema
    return application_stream(spark, sf_dir, schema, "customer.parquet")


@query(FULL_STORE)
def stream_feature_store(spark, sf_dir):
    """Applications arrive as a stream, histories are stored tables; same result as the batch build."""
    tables = roles.loan_tables(spark, sf_dir)
    aggregates = HistoryAggregator(tables, scratch_path(spark, "aggregates")).fit(tables["application"]).aggregates

    def features(stream):
        return join_histories(add_row_features(roles.as_role(stream, "application"), epsilon=contract.STORE_EPSILON), aggregates)

    return rounded(run_available(_applications(spark, sf_dir), features, scratch_path(spark, "stream"), scratch_path(spark, "progress")))


@query(SCORE_SQL.format(names="('logistic_regression')"))
def score_stream(spark, sf_dir):
    """The same rows as ``score_batch`` gives for the model, with the histories stored beforehand."""
    return checked_scores(streamed_scores(spark, sf_dir, "logistic_regression"))


def streamed_scores(spark, sf_dir, name: str):
    trained, aggregates = saved_model(spark, sf_dir, name), stored_aggregates(spark, sf_dir)
    return run_available(_applications(spark, sf_dir), lambda stream: score(roles.as_role(stream, "application"), trained, aggregates),
                         scratch_path(spark, "scores"), scratch_path(spark, "progress"))


RECORD_FIELDS = ("AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL", "DAYS_BIRTH", "DAYS_EMPLOYED",
                 "DAYS_ID_PUBLISH", "CODE_GENDER", "FLAG_OWN_CAR", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS",
                 "NAME_CONTRACT_TYPE", "REGION_RATING_CLIENT_W_CITY")
RECORDS = {"NAME_FAMILY_STATUS": "'Married'", "NAME_CONTRACT_TYPE": "CASE WHEN SK_ID_CURR % 23 = 0 THEN NULL ELSE 'Cash loans' END"}
RECORD_SQL = ", ".join(f"{e} AS {c}" for c, e in RECORDS.items())
PROBLEM_SQL = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in RECORD_FIELDS)


@query(f"{with_roles('application')}, r AS (SELECT *, {RECORD_SQL} FROM application) "
       f"SELECT SK_ID_CURR, concat_ws(',', {PROBLEM_SQL}) AS problems FROM r WHERE concat_ws(',', {PROBLEM_SQL}) <> ''")
def rejected_records(spark, sf_dir):
    records = roles.role_table(spark, sf_dir, "application").selectExpr("*", *[f"{e} AS {c}" for c, e in RECORDS.items()])
    return check_records(records)[1].select("SK_ID_CURR", F.concat_ws(",", "problems").alias("problems"))


@query(f"{with_roles('application')}, r AS (SELECT *, {RECORD_SQL} FROM application) "
       f"SELECT SK_ID_CURR, concat_ws(',', {PROBLEM_SQL}) = '' AS accepted, concat_ws(',', {PROBLEM_SQL}) AS problems FROM r")
def stream_checked_records(spark, sf_dir):
    """Accepted and rejected records of a stream, from the two folders they were written to."""
    records = roles.as_role(_applications(spark, sf_dir), "application").selectExpr("*", *[f"{e} AS {c}" for c, e in RECORDS.items()])
    good, bad = split_stream(records, scratch_path(spark, "accepted"), scratch_path(spark, "rejected"), scratch_path(spark, "progress"))
    return (good.select("SK_ID_CURR", F.lit(True).alias("accepted"), F.lit("").alias("problems"))
            .unionByName(bad.select("SK_ID_CURR", F.lit(False).alias("accepted"), F.concat_ws(",", "problems").alias("problems"))))
