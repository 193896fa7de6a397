"""Pieces shared by the queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import roles

DIGITS = 6
STD_DIGITS = 4
# Means of shares are fractions with many factors of two: six digits would
# put some of them exactly on a rounding boundary.
SHARE_DIGITS = 9


def app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.role_table(spark, sf_dir, "application")


def with_roles(*names: str) -> str:
    """``WITH application AS (...), ...`` for the named roles."""
    return "WITH " + ", ".join(f"{n} AS ({roles.select_sql(n)})" for n in names)


def digits_for(column: str) -> int:
    if column.endswith("_STD"):
        return STD_DIGITS
    return SHARE_DIGITS if "STATUS_PCT" in column else DIGITS


def rounded(df: DataFrame) -> DataFrame:
    """Engines sum in different orders; the last bits of doubles are not compared."""
    return df.select(*[
        F.round(f.name, digits_for(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def rounded_sql(expression: str, name: str) -> str:
    return f"round({expression}, {digits_for(name)}) AS {name}"
