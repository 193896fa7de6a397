"""Reproducible splits.

Membership is a function of the row id and the seed, so it needs no shuffle
and survives repartitioning.  The thresholds are exact order statistics of the
hash within each class, found without ranking a class in one task; every class
gets the asked share to the row.  ``exact=False`` takes the share of the hash
range instead: no job, but strata only up to sampling noise.  Rows without a
label belong to no stratum and are refused.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract
from ..functions.hashing import HASH_SPACE, row_hash
from .quantiles import exact_quantiles


def _class_thresholds(df: DataFrame, label: str, hashed: Column, ranks: Callable[[int], list[int]],
                      **quantile_options) -> dict[object, list[float]]:
    """Per class, hash values with exactly ``ranks(rows)`` rows at or below them."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if None in sizes:
        raise ValueError(f"{sizes[None]} rows have no {label}, so they cannot be split by it")
    result = {}
    for value, rows in sizes.items():
        wanted = ranks(rows)
        inner = sorted({k for k in wanted if 0 < k < rows})
        found = {0: -1.0, rows: float(HASH_SPACE)}
        if inner:
            one_class = df.where(F.col(label) == F.lit(value)).select(hashed.alias("_hash"))
            # Half-way between the k-th and the next hash.
            levels = [(k - 0.5) / (rows - 1) for k in inner]
            cuts = exact_quantiles(one_class, ["_hash"], levels, **quantile_options).collect()
            by_level = {r["prob"]: r["value"] for r in cuts}
            found.update({k: by_level[p] for k, p in zip(inner, levels)})
        result[value] = [found[k] for k in wanted]
    return result


def _per_class(label: str, thresholds: dict[object, list[float]], expression: Callable[[list[float]], Column]) -> Column:
    chosen = F.lit(None)
    for value, cuts in thresholds.items():
        chosen = F.when(F.col(label) == F.lit(value), expression(cuts)).otherwise(chosen)
    return chosen


def stratified_holdout(df: DataFrame, row_id: str = contract.ID_COLUMN, label: str = contract.TARGET_COLUMN,
                       test_size: float = contract.TEST_SIZE, seed: int = contract.SEED, exact: bool = True,
                       output: str = "is_test", **quantile_options) -> DataFrame:
    """Flag the held-out rows."""
    hashed = row_hash(row_id, seed)
    if not exact:
        return df.withColumn(output, (hashed < F.lit(int(test_size * HASH_SPACE))).cast("int"))
    thresholds = _class_thresholds(df, label, hashed, lambda n: [int(n * test_size + 0.5)], **quantile_options)
    return df.withColumn(output, _per_class(label, thresholds, lambda c: (hashed <= F.lit(c[0])).cast("int")))


def train_and_test(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    flagged = stratified_holdout(df, output="_is_test", **options)
    return (flagged.where(F.col("_is_test") == 0).drop("_is_test"), flagged.where(F.col("_is_test") == 1).drop("_is_test"))


def stratified_folds(df: DataFrame, row_id: str = contract.ID_COLUMN, label: str = contract.TARGET_COLUMN,
                     folds: int = contract.CV_FOLDS, seed: int = contract.SEED, exact: bool = True,
                     output: str = "fold", **quantile_options) -> DataFrame:
    """R2: fold number; class sizes differ by at most one between folds."""
    hashed = row_hash(row_id, seed)
    if not exact:
        return df.withColumn(output, F.pmod(hashed, F.lit(folds)).cast("int"))
    thresholds = _class_thresholds(df, label, hashed, lambda n: [n * i // folds for i in range(1, folds)], **quantile_options)
    return df.withColumn(output, _per_class(
        label, thresholds, lambda cuts: reduce(add, [(hashed > F.lit(c)).cast("int") for c in cuts])))


def plain_fold(row_id: str, folds: int, seed: int = contract.SEED) -> Column:
    return F.pmod(row_hash(row_id, seed), F.lit(folds)).cast("int")


def plain_folds(df: DataFrame, row_id: str = contract.ID_COLUMN, folds: int = contract.CV_FOLDS,
                seed: int = contract.SEED, output: str = "fold") -> DataFrame:
    """Never more folds than rows, never fewer than two."""
    few = df.select(row_id).limit(folds).count()
    return df.withColumn(output, plain_fold(row_id, min(folds, max(2, few)), seed))
