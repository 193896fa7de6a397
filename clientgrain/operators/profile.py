"""Profiles of a raw table.

Per-column results come out as rows.  Columns are melted to (column, value)
pairs where a statistic needs a shuffle, so that the shuffle is keyed by value
and stays narrow, and no single task sees a whole column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..functions import stats as ST
from .history import numeric_columns
from .quantiles import exact_quantiles, melt


def _is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _one_row_per_column(row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """Turn the single row ``_0, _1, ...`` into (column, value) rows."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias(value)) for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*pairs)))


def missing_share(df: DataFrame) -> DataFrame:
    """Share of missing values per column, highest first."""
    row = df.agg(*[F.avg(_is_missing(df, c).cast("double")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return _one_row_per_column(row, df.columns, "missing_share").orderBy(F.desc("missing_share"), "column")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """A10: distinct known values per column, fewest first."""
    columns = list(columns or df.columns)
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(f"_{i}") for i, c in enumerate(columns)])
        return _one_row_per_column(row, columns, "n_distinct").orderBy("n_distinct", "column")
    # Keep each value's own type: a string form would take 0.0 and -0.0 apart.
    by_type: dict[str, list[str]] = {}
    for c in columns:
        data_type = df.schema[c].dataType
        kind = "bigint" if isinstance(data_type, T.IntegralType) else data_type.simpleString()
        by_type.setdefault(kind, []).append(c)
    parts = []
    for kind, names in by_type.items():
        values = melt(df, names, as_type=kind).where(F.col("value").isNotNull())
        if kind in ("double", "float"):
            values = values.where(~F.isnan("value"))
        parts.append(values.groupBy("column", "value").agg(F.lit(1).alias("_")).select("column"))
    seen = reduce(DataFrame.unionByName, parts).groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    # Columns without any known value have no row above; the empty aggregate adds them.
    every = _one_row_per_column(df.limit(0).agg(*[F.count(F.lit(1)).alias(f"_{i}") for i in range(len(columns))]),
                                columns, "_none")
    return (every.join(seen, "column", "left")
            .select("column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))
            .orderBy("n_distinct", "column"))


def few_values(counts: DataFrame, at_most: int = 5) -> DataFrame:
    return counts.where(F.col("n_distinct") <= at_most)


def many_values(counts: DataFrame, above: int = 50) -> DataFrame:
    return counts.where(F.col("n_distinct") > above)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each known value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = df.agg(F.count(column).alias("known")).scalar()
    return (counts.select(F.col(column).cast("string").alias("value"), "n", (F.col("n") / known).alias("share"))
            .orderBy(F.desc("n"), "value"))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, **quantile_options) -> DataFrame:
    """Count, mean, std, min, quartiles, max and adjusted skew per numeric column."""
    columns = numeric_columns(df) if columns is None else list(columns)
    v = F.col("value")
    moments = melt(df, columns).groupBy("column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), ST.adjusted_skew(v).alias("skew"))
    quantiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], **quantile_options)
    wide = quantiles.groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
    ])
    return moments.join(wide, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "median", "q75", "max", "skew")


def tail_quantiles(df: DataFrame, columns: Sequence[str], **quantile_options) -> DataFrame:
    """Min, 1 %, 99 % and max."""
    extremes = melt(df, columns).groupBy("column").agg(F.min("value").alias("min"), F.max("value").alias("max"))
    quantiles = exact_quantiles(df, columns, [0.01, 0.99], **quantile_options).groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.01, F.col("value"))).alias("q01"),
        F.max(F.when(F.col("prob") == 0.99, F.col("value"))).alias("q99"))
    return extremes.join(quantiles, "column", "left").select("column", "min", "q01", "q99", "max")


def binned_rate(df: DataFrame, value: Column, label: str, bins: int = 10) -> DataFrame:
    """Mean label per equal-width bin; right-closed, lowest edge widened by 0.1 %, empty bins left out."""
    rows = df.select(value.cast("double").alias("_v"), F.col(label).alias("_y"))
    spans = rows.agg(F.min("_v").alias("low"), F.max("_v").alias("high"))
    span = spans.select(F.struct("low", "high")).scalar()
    rows = rows.withColumn("_span", span)
    low, high = F.col("_span.low"), F.col("_span.high")
    # A constant column gets a narrow range around its value.
    pad = F.when(low == high, F.when(low != 0, F.abs(low) * 0.001).otherwise(F.lit(0.001))).otherwise(F.lit(0.0))
    first, last = low - pad, high + pad
    step = (last - first) / F.lit(bins)

    def edge(i: int) -> Column:
        return first + F.lit(i) * step

    index = reduce(add, [(F.col("_v") > edge(i)).cast("int") for i in range(1, bins)])
    widened = F.when(low == high, first).otherwise(first - (last - first) * 0.001)
    left = F.when(F.col("bin") == 0, widened).otherwise(first + F.col("bin") * step)
    return (
        rows.where(F.col("_v").isNotNull()).withColumn("bin", index)
        .select("bin", left.alias("low"), F.when(F.col("bin") == bins - 1, last).otherwise(first + (F.col("bin") + 1) * step).alias("high"), "_y")
        .groupBy("bin", "low", "high").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("rate"))
        .orderBy("bin")
    )


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows meeting each named condition, in one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def binary_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whether the known values of each column are a subset of {0, 1}; all-null columns are."""
    columns = list(columns or df.columns)
    numeric = set(numeric_columns(df))

    def check(name: str) -> Column:
        if name in numeric:
            value = F.when(~_is_missing(df, name), F.col(name))
            return F.coalesce(F.bool_and(value.isin(0, 1)), F.lit(True))
        if isinstance(df.schema[name].dataType, T.BooleanType):
            return F.lit(True)
        return F.count(name) == 0

    row = df.agg(*[check(c).alias(f"_{i}") for i, c in enumerate(columns)])
    return _one_row_per_column(row, columns, "is_binary")


def table_shape(df: DataFrame, label: str | None = None) -> DataFrame:
    """Rows, columns and, with a label, the positive rate."""
    aggregates = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")]
    if label:
        aggregates.append(F.avg(label).alias("positive_rate"))
    return df.agg(*aggregates)


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """T4: head of a sorted profile."""
    return df.orderBy(*order).limit(n)


def age_in_whole_years(days: str = "DAYS_BIRTH") -> Column:
    """The profile truncates ages; the feature store rounds them to a tenth."""
    return (-F.col(days) / F.lit(S.DAYS_PER_YEAR)).cast("int")
