"""Row-level expressions (inventory P1-P11, P13, P14, P16, P18).

All of them are plain Catalyst expressions and keep the missing-value rules of
the survey: null stays null, NaN never appears after ingest.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAYS_PER_YEAR = 365

# What the reference's numeric parser accepts: optional sign, digits with an
# optional fraction and exponent, or a spelled-out infinity.
NUMBER_PATTERN = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and null mean the same in the source data; keep only null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats}) if floats else df


def days_to_years(days: Column | str, digits: int = 1) -> Column:
    """Days before application (negative) to positive years."""
    return F.bround(-as_column(days) / F.lit(DAYS_PER_YEAR), digits)


def fixed_bins(value: Column, edges: Sequence[float], labels: Sequence[object]) -> Column:
    """Label of the right-closed interval (edges[i], edges[i+1]]; outside is null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    result = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        result = F.when(inside, F.lit(label)) if result is None else result.when(inside, F.lit(label))
    return result


def sentinel_flag(value: Column | str, sentinel: float) -> Column:
    """1 where the sentinel stands, 0 elsewhere, null included."""
    return F.coalesce(as_column(value) == F.lit(sentinel), F.lit(False)).cast("int")


def sentinel_to_null(value: Column | str, sentinel: float) -> Column:
    """P4."""
    return F.when(as_column(value) != F.lit(sentinel), as_column(value))


def floor_at(value: Column, low: float) -> Column:
    """Clip from below; ``greatest`` alone would turn null into the bound."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(low)))


def years_with_floor(days: Column | str, digits: int = 1) -> Column:
    """P5: like P1 but never negative."""
    return F.bround(floor_at(-as_column(days) / F.lit(DAYS_PER_YEAR), 0.0), digits)


def epsilon_ratio(numerator: Column | str, denominator: Column | str, epsilon: float) -> Column:
    """N / (d + epsilon); a zero denominator gives null rather than infinity."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator) + F.lit(epsilon))


def non_negative_difference(left: Column | str, right: Column | str) -> Column:
    """P7."""
    return floor_at(as_column(left) - as_column(right), 0.0)


def row_sum(cols: Iterable[str]) -> Column:
    """P10: nulls count as zero, so an all-null row sums to 0."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the known values, null when none is known."""
    known = reduce(add, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(row_sum(cols).cast("double"), known)


def row_min(cols: Sequence[str]) -> Column:
    return F.least(*[F.col(c) for c in cols])


def row_max(cols: Sequence[str]) -> Column:
    return F.greatest(*[F.col(c) for c in cols])


def row_range(cols: Sequence[str]) -> Column:
    """P9."""
    return row_max(cols) - row_min(cols)


def prefix_columns(columns: Iterable[str], prefix: str) -> list[str]:
    return [c for c in columns if c.startswith(prefix)]


def square(value: Column | str) -> Column:
    """P11."""
    return as_column(value) * as_column(value)


def to_number(text: Column | str) -> Column:
    """Number or null.  The pattern stops Spark from reading '1d' as 1."""
    c = as_column(text)
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def yes_no_text(value: Column | str) -> Column:
    """Y/N in either case to '1'/'0'; anything else as it was."""
    c = as_column(value)
    return F.when(c.isin("Y", "y"), F.lit("1")).when(c.isin("N", "n"), F.lit("0")).otherwise(c)


def fill_label(value: Column | str, label: str) -> Column:
    """Constant label in place of null."""
    return F.coalesce(as_column(value), F.lit(label))


def at_or_above(probability: Column | str, threshold: float) -> Column:
    """P18."""
    return (as_column(probability) >= F.lit(threshold)).cast("int")
