"""Feature names: differences, coverage and suggested kinds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract
from .history import numeric_columns
from .profile import binary_columns


def names_table(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(position, name) rows of a column-name list."""
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "position bigint, name string")


def difference(left: DataFrame, right: DataFrame, name: str = "name") -> DataFrame:
    """Names of the left table that the right one lacks, each once, sorted."""
    return left.select(name).distinct().join(right.select(name).distinct(), name, "left_anti").orderBy(name)


def ordered_distinct(df: DataFrame, name: str = "name", position: str = "position") -> DataFrame:
    """Each name once, in order of first appearance."""
    return df.groupBy(name).agg(F.min(position).alias(position)).orderBy(position)


def coverage(store: DataFrame, used: Sequence[str], configured: Sequence[str],
             control: Sequence[str] = (contract.ID_COLUMN, contract.TARGET_COLUMN)) -> DataFrame:
    """(section, name, dtype) rows; reads the store's schema, not its data."""
    spark = store.sparkSession
    kept = [f for f in store.schema.fields if f.name not in control]
    types = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in kept] or [], "name string, dtype string")
    in_store = types.select("name")
    in_use, in_config = (names_table(spark, dict.fromkeys(n)).select("name") for n in (used, configured))
    sections = (("missing_in_pipeline", difference(in_store, in_use)),
                ("missing_in_config", difference(in_store, in_config)),
                ("extra_in_config", difference(in_config, in_store)))
    result = None
    for section, names in sections:
        part = names.join(types, "name", "left").select(F.lit(section).alias("section"), "name", "dtype")
        result = part if result is None else result.unionByName(part)
    return result


def coverage_counts(store: DataFrame, report: DataFrame,
                    control: Sequence[str] = (contract.ID_COLUMN, contract.TARGET_COLUMN)) -> DataFrame:
    """How many names the store has and how many each section lists."""
    stored = len([c for c in store.columns if c not in control])
    return report.agg(F.lit(stored).cast("bigint").alias("store_columns"), *[
        F.count_if(F.col("section") == s).alias(s) for s in ("missing_in_pipeline", "missing_in_config", "extra_in_config")
    ])


def suggest_kinds(df: DataFrame, columns: Sequence[str] | None = None,
                  control: Sequence[str] = (contract.ID_COLUMN, contract.TARGET_COLUMN),
                  numeric_flags: bool = True) -> DataFrame:
    """Numeric, categorical or binary for each column, sorted by name.

    Every column gets a kind: numbers are numeric, booleans binary, all else
    (text, dates, timestamps, nested values) categorical.  Whether a column is
    binary takes one pass over the data, for all columns at once.  By default
    numeric columns holding only 0 and 1 are binary; with
    ``numeric_flags=False`` numbers stay numeric and the test applies to the
    others, which pass it as booleans or when empty.
    """
    columns = [c for c in (columns or df.columns) if c not in control]
    numeric = numeric_columns(df.select(*columns))
    flags = [c for c in columns if isinstance(df.schema[c].dataType, T.BooleanType)]
    is_number, is_flag = F.col("column").isin(numeric), F.col("column").isin(flags)
    binary = is_flag | (F.col("is_binary") & (is_number if numeric_flags else ~is_number))
    kind = F.when(binary, "binary").when(is_number, "numeric").otherwise("categorical")
    return binary_columns(df, columns).select("column", kind.alias("kind")).orderBy("column")
