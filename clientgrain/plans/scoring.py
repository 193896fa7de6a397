"""Scoring of new applications."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import contract
from ..functions import scalars as S
from ..operators.history import join_histories
from ..operators.row_features import add_row_features
from ..sources.schemas import scoring_record_schema
from .training import SCORE, Trained, scored

PROBLEMS = "problems"


def missing_fields(df: DataFrame, schema: StructType) -> Column:
    """Names of required fields that are absent or null in a row."""
    have = set(df.columns)
    checks = [F.lit(f.name) if f.name not in have else F.when(F.col(f.name).isNull(), F.lit(f.name))
              for f in schema.fields if not f.nullable]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def check_records(df: DataFrame, schema: StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """The records that satisfy the request contract, and the others with what they lack."""
    schema = schema or scoring_record_schema()
    have = set(df.columns)
    typed = df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.name in have})
    typed = typed.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.nullable and f.name not in have})
    flagged = typed.withColumn(PROBLEMS, missing_fields(typed, schema))
    accepted = flagged.where(F.size(PROBLEMS) == 0).drop(PROBLEMS)
    return accepted, flagged.where(F.size(PROBLEMS) > 0)


def decisions(df: DataFrame, row_id: str, model_name: str, threshold: float) -> DataFrame:
    """(id, model_name, prediction, probability, threshold): the threshold is the one applied."""
    return df.select(row_id, F.lit(model_name).alias("model_name"), S.at_or_above(SCORE, threshold).alias("prediction"),
                     F.col(SCORE).alias("probability"), F.lit(float(threshold)).alias("threshold"))


def score(records: DataFrame, trained: Trained, aggregates: Mapping[str, DataFrame] | None = None,
          row_id: str = contract.ID_COLUMN, threshold: float = contract.DEFAULT_THRESHOLD,
          epsilon: float = contract.STORE_EPSILON) -> DataFrame:
    """G1: features, probability and decision for each record.

    Works alike on a table and on a stream: it only projects, and joins
    stored tables on the right.  Columns the model knows and the records lack
    are null, to be filled as the model's own stages do.
    """
    featured = add_row_features(records, epsilon=epsilon)
    if aggregates:
        featured = join_histories(featured, aggregates)
    return decisions(scored(trained, featured, [row_id], as_probability=True), row_id, trained.name, threshold)
