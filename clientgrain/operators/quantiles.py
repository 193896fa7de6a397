"""Exact quantiles with linear interpolation, for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task.
That is right while groups are small.  Above ``group_rows`` the exact order
statistics are found in two scans instead:

1. a mergeable sketch brackets every wanted rank from below and above;
2. values inside a bracket are counted by value, those below it as one number,
   so map-side combining leaves only a sliver of the rows to shuffle, and
   running totals over that sliver locate the exact rank.

With many groups, a bracket for each of those up to ``group_rows`` would be more
to move than their values: these are counted by value, and an ordered window
over the counts of each group gives all its ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut, null_safe_join
from .running import SINGLE_PASS_ROWS, running_totals

GROUP_ROWS = 200_000
SKETCH_ACCURACY = 10_000


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), value: str = "value",
         as_type: str = "double") -> DataFrame:
    """(by..., column, value) rows of the given columns; nulls stay."""
    if not cols:
        raise ValueError("no columns to melt")
    typed = df.select(*by, *[F.col(c).cast(as_type).alias(c) for c in cols])
    return typed.unpivot(list(by), list(cols), "column", value)


def _spread(column: str, probs: Sequence[float], quantiles: Column, known: Column) -> Column:
    return F.array(*[
        F.struct(F.lit(column).alias("column"), F.lit(float(p)).alias("prob"),
                 known.alias("n"), quantiles[i].alias("value"))
        for i, p in enumerate(probs)
    ])


def _built_in(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    levels = F.array(*[F.lit(float(p)) for p in probs])
    aggregates = []
    for i, c in enumerate(cols):
        aggregates += [F.percentile(F.col(c).cast("double"), levels).alias(f"_q{i}"), F.count(c).alias(f"_n{i}")]
    spread = F.flatten(F.array(*[_spread(c, probs, F.col(f"_q{i}"), F.col(f"_n{i}")) for i, c in enumerate(cols)]))
    return df.groupBy(*by).agg(*aggregates).select(*by, F.explode(spread).alias("r")).select(*by, "r.*")


def _brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str],
              accuracy: int) -> DataFrame:
    """(by..., column, n, prob, low, high) with the wanted rank inside [low, high]."""
    margin = 4.0 / accuracy
    levels = []
    for p in probs:
        levels += [max(0.0, p - margin), min(1.0, p + margin)]
    aggregates = []
    for i, c in enumerate(cols):
        sketch = F.percentile_approx(F.col(c).cast("double"), levels, accuracy)
        aggregates += [sketch.alias(f"_s{i}"), F.count(c).alias(f"_n{i}")]
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(f"_n{i}").alias("n"),
                 F.col(f"_s{i}")[2 * j].alias("low"), F.col(f"_s{i}")[2 * j + 1].alias("high"))
        for i, c in enumerate(cols) for j, p in enumerate(probs)
    ]
    return df.groupBy(*by).agg(*aggregates).select(*by, F.explode(F.array(*entries)).alias("r")).select(*by, "r.*")


def _located(df: DataFrame, brackets: DataFrame, bracket_rows: int, cols: Sequence[str], by: Sequence[str],
             single_pass_rows: int) -> DataFrame:
    """Exact value per bracket; null where the bracket missed the rank."""
    group = [*by, "column", "prob"]
    values = melt(df, cols, by).where(F.col("value").isNotNull())
    near = null_safe_join(values, broadcast_if_small(brackets, bracket_rows), [*by, "column"]).where(F.col("value") <= F.col("high"))
    counted = near.groupBy(*group, "n", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value")).agg(
        F.count(F.lit(1)).alias("rows"))
    ranked = running_totals(counted, group, ["value"], ["rows"], single_pass_rows)
    position = F.col("prob") * (F.col("n") - 1)
    ranked = ranked.withColumns({"_position": position, "_floor": F.floor(position), "_ceil": F.ceil(position)})
    position, floor, ceil = (F.col(c) for c in ("_position", "_floor", "_ceil"))
    found = ranked.groupBy(*group, "n", "_position", "_floor", "_ceil").agg(
        _holding(floor).alias("_low"), _holding(ceil).alias("_high"))
    return found.select(*group, "n", _blended(position, F.col("_low"), F.col("_high")).alias("value"))


def _holding(rank: Column) -> Column:
    """The value whose rows hold the rank."""
    return F.max(F.when((F.col("rows_before") <= rank) & (rank < F.col("rows_before") + F.col("rows")), F.col("value")))


def _blended(position: Column, low: Column, high: Column) -> Column:
    floor, ceil = F.floor(position), F.ceil(position)
    return F.when(floor == ceil, low).otherwise((ceil - position) * low + (position - floor) * high)


def _counted(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Exact values of groups of a bounded size; no row where nothing is known."""
    group = [*by, "column"]
    values = melt(df, cols, by).where(F.col("value").isNotNull())
    # Dealt by group and not by column, so that whoever goes on by group need not deal again.
    counted = values.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("rows")).repartition(*by)
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumns({"n": F.sum("rows").over(whole), "rows_before": F.coalesce(F.sum("rows").over(earlier), F.lit(0))})
    places = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ends = [_holding(end(place)).alias(f"_{side}{i}") for i, place in enumerate(places) for side, end in (("low", F.floor), ("high", F.ceil))]
    entries = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col("n"), _blended(place, F.col(f"_low{i}"), F.col(f"_high{i}")).alias("value"))
                        for i, (p, place) in enumerate(zip(probs, places))])
    return ranked.groupBy(*group, "n").agg(*ends).select(*group, F.explode(entries).alias("r")).select(*group, "r.*")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    group_rows: int = GROUP_ROWS, accuracy: int = SKETCH_ACCURACY,
                    single_pass_rows: int = SINGLE_PASS_ROWS) -> DataFrame:
    """(by..., column, prob, n, value), exact for every group; a null in ``by`` is a group of its own.

    Runs jobs: use it where statistics are learned.  ``by`` is meant for
    groups of which some may be too large for ``percentile`` (class labels,
    hot keys); small groups alone belong in a plain ``groupBy`` with it.
    """
    by = list(by)
    needed = df.select(*by, *cols)
    counts = [F.count(c).alias(f"_n{i}") for i, c in enumerate(cols)]
    if not by:
        if max(needed.agg(*counts).first()) <= group_rows:
            return _built_in(needed, cols, probs, by)
        return _bracketed(needed, cols, probs, by, accuracy, single_pass_rows)
    sizes = cut(needed.groupBy(*by).agg(*counts))
    is_large = F.array_max(F.array(*[F.col(f"_n{i}") for i in range(len(cols))])) > min(group_rows, single_pass_rows)
    large, small = sizes.where(is_large).select(*by), sizes.where(~is_large)
    n_large = large.count()
    few = broadcast_if_small(large, n_large)
    parts = [_counted(null_safe_join(needed, few, by, "left_anti") if n_large else needed, cols, probs, by)]
    nothing = [F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(f"_n{i}").alias("n"),
                        F.lit(None).cast("double").alias("value")) for i, c in enumerate(cols) for p in probs]
    empty = small.select(*by, F.explode(F.array(*nothing)).alias("r")).select(*by, "r.*").where(F.col("n") == 0)
    if not empty.isEmpty():
        parts.append(empty)
    if n_large:
        parts.append(_bracketed(null_safe_join(needed, few, by, "left_semi"), cols, probs, by, accuracy, single_pass_rows))
    return reduce(DataFrame.unionByName, parts)


def _bracketed(needed: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str], accuracy: int,
               single_pass_rows: int) -> DataFrame:
    brackets = cut(_brackets(needed, cols, probs, by, accuracy))
    bracket_rows = brackets.count()
    located = cut(_located(needed, brackets, bracket_rows, cols, by, single_pass_rows))
    found = located.where(F.col("value").isNotNull()).select(*by, "column", "prob")
    missed = null_safe_join(brackets.where(F.col("n") > 0), found, [*by, "column", "prob"], "left_anti")
    if not missed.isEmpty():
        # A sketch outside its error bound; the same search with open brackets is always exact.
        opened = cut(missed.withColumns({"low": F.lit(float("-inf")), "high": F.lit(float("inf"))}))
        again = _located(needed, opened, opened.count(), cols, by, single_pass_rows)
        located = located.where(F.col("value").isNotNull()).unionByName(again)
    empty = brackets.where(F.col("n") == 0).select(*by, "column", "prob", "n", F.lit(None).cast("double").alias("value"))
    return located.unionByName(empty)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], **kwargs) -> dict[str, list[float | None]]:
    """Quantiles per column on the driver: as many numbers as columns times ``probs``."""
    rows = exact_quantiles(df, cols, probs, **kwargs).collect()
    found = {(r["column"], r["prob"]): r["value"] for r in rows}
    return {c: [found.get((c, float(p))) for p in probs] for c in cols}
