"""Permutation importance and feature selection."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contract
from ..functions.hashing import row_hash
from ..operators import columnar
from ..operators import metrics as MT
from ..operators.routing import FEATURES
from ..session import cut
from .models import spec_for
from .training import SCORE, Trained

REPEATS = 5
BUCKET_ROWS = 10_000
# The margins of one slot and repeat that one task orders, and the rows their cells are laid out by.
CELL_ROWS = 100_000
SAMPLE_ROWS = 20_000


def _with_donors(base: DataFrame, row_id: str, buckets: int, seed: int) -> DataFrame:
    """Give every row another row's features: ``donor``.

    Rows fall into random buckets of bounded size; inside a bucket each takes
    the values of the next row in a random order, the last those of the first.
    That permutes every feature with one shuffle by bucket.
    """
    placed = base.withColumns({"_bucket": F.pmod(row_hash(row_id, seed), F.lit(buckets)),
                               "_order": row_hash(row_id, seed + 1)})
    ring = Window.partitionBy("_bucket").orderBy("_order", row_id)
    donor = F.coalesce(F.lead("x").over(ring), F.first("x").over(ring))
    return placed.withColumn("donor", donor).drop("_bucket", "_order")


def used_slots(model, n: int) -> list[int]:
    """Slots the model looks at; permuting any other changes no score."""
    if hasattr(model, "used_features"):
        return sorted(model.used_features)
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
        return [i for i in range(n) if weights[i] != 0]
    if hasattr(model, "coefficientMatrix"):
        weights = abs(model.coefficientMatrix.toArray()).max(axis=0)
        return [i for i in range(n) if weights[i] != 0]
    if hasattr(model, "coefficients"):
        weights = model.coefficients.toArray()
        return [i for i in range(n) if weights[i] != 0]
    return list(range(n))


def linear_weights(model) -> list[float] | None:
    """The weight of each slot in a linear model's margin; None for other models."""
    if hasattr(model, "coefficients") and hasattr(model, "intercept"):
        return [float(w) for w in model.coefficients.toArray()]
    return None


def _drops(areas: DataFrame, baseline: float) -> DataFrame:
    """(_slot, importance, importance_std) of (_repeat, _slot, roc_auc)."""
    drops = areas.withColumn("_drop", F.lit(baseline) - F.col("roc_auc"))
    return drops.groupBy("_slot").agg(F.avg("_drop").alias("importance"), F.stddev_pop("_drop").alias("importance_std"))


def _with_repeats(base: DataFrame, row_id: str, repeats: int, seed: int, bucket_rows: int, n_rows: int) -> DataFrame:
    buckets = max(1, math.ceil(n_rows / bucket_rows))
    return reduce(DataFrame.unionByName, [
        _with_donors(base, row_id, buckets, seed + 2 * r + 2).withColumn("_repeat", F.lit(r)) for r in range(repeats)])


def _cell_bounds(base: DataFrame, weight: Column, n_slots: int, used: Sequence[int], row_id: str, seed: int, n_rows: int) -> dict[int, list[int]]:
    """Where the cells of each slot's moved margins end, from a sample of the rows; that decides who orders a margin, not the result."""
    cells = math.ceil(n_rows / CELL_ROWS)
    if cells < 2:
        return {}
    every = max(1, n_rows // SAMPLE_ROWS)
    sample = _with_donors(base.where(F.pmod(row_hash(row_id, seed), F.lit(every)) == 0), row_id, max(1, SAMPLE_ROWS // BUCKET_ROWS), seed + 1)
    moved = F.transform(F.zip_with("x", "donor", lambda own, other: other - own), lambda v, i: F.col("_margin") + v * F.get(weight, i))
    arrays = cut(sample.where(F.col("x").isNotNull() & F.col("donor").isNotNull()).select(moved.alias("x")))
    found = columnar.bounds(arrays, n_slots, cells)
    return {s: found[s] for s in used}


def linear_importance(base: DataFrame, weights: Sequence[float], names: Sequence[str], label: str = contract.TARGET_COLUMN,
                      row_id: str = contract.ID_COLUMN, repeats: int = REPEATS, seed: int = contract.SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """M12 for a linear margin over ``base`` (row id, label, array ``x``): (feature, importance, importance_std).

    A permuted slot changes a row's margin by weight times (donor - own), so no
    vector is copied and no row scored again: a variant is a margin, and
    ``columnar.moved_areas`` orders them as packed numbers.
    """
    weight = F.lit([float(w) for w in weights])
    margin = F.aggregate(F.zip_with("x", weight, lambda v, w: v * w), F.lit(0.0), lambda a, v: a + v)
    base = cut(base.select(row_id, label, "x", margin.alias("_margin")))
    baseline = MT.roc_auc(base.withColumn(SCORE, F.col("_margin")), label, SCORE).first()["roc_auc"]
    slots = base.sparkSession.createDataFrame(list(enumerate(names)), "_slot int, feature string")
    used = [i for i, w in enumerate(weights) if w]
    if used and baseline is not None:
        n_rows = base.count()
        permuted = _with_repeats(base, row_id, repeats, seed, bucket_rows, n_rows)
        areas = columnar.moved_areas(permuted, label, weights, used, _cell_bounds(base, weight, len(weights), used, row_id, seed, n_rows))
        slots = slots.join(_drops(areas, baseline), "_slot", "left")
    else:
        slots = slots.withColumns({"importance": F.lit(None).cast("double"), "importance_std": F.lit(None).cast("double")})
    return _named(slots, used)


def _named(slots: DataFrame, used: Sequence[int]) -> DataFrame:
    is_used = F.array_contains(F.lit(list(used)).cast("array<int>"), F.col("_slot"))
    return slots.select("feature", *[F.when(is_used, F.col(c)).otherwise(0.0).alias(c) for c in ("importance", "importance_std")]
                        ).orderBy(F.desc("importance"), "feature")


def permutation_importance(model, rows: DataFrame, names: Sequence[str], score: Column,
                           label: str = contract.TARGET_COLUMN, row_id: str = contract.ID_COLUMN,
                           repeats: int = REPEATS, seed: int = contract.SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(feature, importance, importance_std): loss of AUC when one feature is permuted.

    ``rows`` holds the assembled vectors of held-out rows; they are stored
    once, and the unchanged rows are scored once.  Linear models see
    ``linear_importance``.  For the others each row comes once per repeat and
    feature the model uses, with that slot taken from its donor; features it
    does not use lose exactly nothing.
    """
    base = rows.select(row_id, F.col(label).cast("int").alias(label), vector_to_array(FEATURES).alias("x"))
    weights = linear_weights(model)
    if weights is not None:
        return linear_importance(base, weights, names, label, row_id, repeats, seed, bucket_rows)
    base = cut(base)
    n = len(names)
    used = used_slots(model, n)
    slots = rows.sparkSession.createDataFrame(list(enumerate(names)), "_slot int, feature string")
    if used:
        unchanged = model.transform(base.select(label, array_to_vector("x").alias(FEATURES))).withColumn(SCORE, score)
        baseline = MT.roc_auc(unchanged, label, SCORE).first()["roc_auc"]
        slot = F.col("_slot")
        variants = _with_repeats(base, row_id, repeats, seed, bucket_rows, base.count()).withColumn("_slot", F.explode(F.array(*[F.lit(i) for i in used])))
        swapped = F.concat(F.slice("x", F.lit(1), slot), F.array(F.get(F.col("donor"), slot)), F.slice("x", slot + 2, F.lit(n)))
        variants = variants.select("_repeat", "_slot", label, array_to_vector(swapped).alias(FEATURES))
        scored = model.transform(variants).withColumn(SCORE, score)
        slots = slots.join(_drops(MT.roc_auc(scored, label, SCORE, ["_repeat", "_slot"]), baseline), "_slot", "left")
    else:
        slots = slots.withColumns({"importance": F.lit(None).cast("double"), "importance_std": F.lit(None).cast("double")})
    return _named(slots, used)


def importance_of(trained: Trained, held_out: DataFrame, label: str = contract.TARGET_COLUMN,
                  row_id: str = contract.ID_COLUMN, **options) -> DataFrame:
    """Importance of the features of a trained model on rows it has not seen."""
    *stages, classifier = trained.model.stages
    prepared = PipelineModel(stages).transform(held_out)
    return permutation_importance(classifier, prepared, trained.features, spec_for(trained.name).score(), label, row_id, **options)


def select_features(importances: DataFrame, threshold: float = contract.IMPORTANCE_THRESHOLD) -> DataFrame:
    """T5: (rank, feature, importance) of the features above the threshold, best first.

    One row per feature of the model, so ranking them is a small sort.
    """
    kept = importances.where(F.col("importance") > threshold)
    order = Window.orderBy(F.desc("importance"), "feature")
    return kept.select(F.row_number().over(order).alias("rank"), "feature", "importance").orderBy("rank")
