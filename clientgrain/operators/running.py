"""Running totals that never pull a group into one task.

A window ordered over a whole table (or over one hot group) runs in a single
task.  Here the rows are range-partitioned by (group, order), each slice sums
up its own rows, and a slice starts from the totals of the slices before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut, null_safe_join

# Up to this many rows in all, one ordered window is cheaper than two passes.
SINGLE_PASS_ROWS = 500_000
# Rows one slice should hold; the number of slices grows with the input.
SLICE_ROWS = 2_000_000
_SLICE = "_slice"


def _before(measure: str, window) -> Column:
    return F.coalesce(F.sum(measure).over(window), F.lit(0))


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], measures: Sequence[str],
                   single_pass_rows: int = SINGLE_PASS_ROWS) -> DataFrame:
    """Add ``{measure}_before``: the sum over earlier rows of the same group.

    (by, order) should be unique; a null in ``by`` is a group of its own, one
    in ``order`` comes first.  The input is written to the shared folder once.
    """
    by = list(by)
    rows = cut(df)
    ordering = [F.col(c).asc_nulls_first() for c in order]
    n_rows = rows.count()
    if n_rows <= single_pass_rows:
        earlier = Window.partitionBy(*by).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumns({f"{m}_before": _before(m, earlier) for m in measures})

    # Slice numbers depend on sampled range bounds, so they are fixed by a cut.
    n_slices = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / SLICE_ROWS))
    slices = cut(rows.repartitionByRange(n_slices, *by, *ordering).withColumn(_SLICE, F.spark_partition_id()))
    totals = slices.groupBy(*by, _SLICE).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    previous = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(totals.select(*by, _SLICE, *[_before(f"_{m}", previous).alias(f"_{m}_offset") for m in measures]))
    earlier = Window.partitionBy(*by, _SLICE).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    within = slices.repartition(n_slices, *by, _SLICE).withColumns({f"_{m}_in": _before(m, earlier) for m in measures})
    return (
        null_safe_join(within, broadcast_if_small(offsets, offsets.count()), [*by, _SLICE])
        .select(*df.columns, *[(F.col(f"_{m}_in") + F.col(f"_{m}_offset")).alias(f"{m}_before") for m in measures])
    )
