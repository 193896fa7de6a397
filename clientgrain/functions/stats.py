"""Named aggregate statistics.

The registry maps the name that ends up in the output column to a function
from a column to an aggregate.  Quartiles carry a leading underscore because
the published feature names have two (``BUREAU_AMT_ANNUITY__Q25``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUANTILE_STATS: dict[str, float] = {"_Q25": 0.25, "_Q75": 0.75}


def total(c: Column) -> Column:
    """Sum that is 0, not null, for a group without known values."""
    return F.coalesce(F.sum(c), F.lit(0))


ALGEBRAIC_STATS: dict[str, Callable[[Column], Column]] = {
    "MEAN": F.avg,
    "MAX": F.max,
    "MIN": F.min,
    "SUM": total,
    "STD": F.stddev_samp,
}

SEVEN_STATS = ("MEAN", "MAX", "MIN", "SUM", "STD", "_Q25", "_Q75")
FOUR_STATS = ("MEAN", "MAX", "MIN", "SUM")


def register_stat(name: str, build: Callable[[Column], Column]) -> None:
    """Add a statistic of one's own; it must be a built-in aggregate expression."""
    if name in QUANTILE_STATS:
        raise ValueError(f"{name} is a quantile")
    ALGEBRAIC_STATS[name] = build


def stat_name(prefix: str, column: str, stat: str) -> str:
    """P20."""
    return f"{prefix}_{column}_{stat}"


def share_of(condition: Column, among: Column) -> Column:
    """Rows meeting the condition over rows where ``among`` is known."""
    return F.try_divide(F.count_if(condition), F.count(among))


def adjusted_skew(c: Column) -> Column:
    """Bias-adjusted skewness; null below three values, 0 for a constant column."""
    n = F.count(c).cast("double")
    raw = F.when(F.stddev_pop(c) == 0, F.lit(0.0)).otherwise(F.skewness(c))
    return F.when(n > 2, raw * F.sqrt(n * (n - 1)) / (n - 2))
