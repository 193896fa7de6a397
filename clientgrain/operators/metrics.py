"""Scores of binary classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import SINGLE_PASS_ROWS, running_totals

# --- fixed values -----------------------------------------------------------
SEVERE_OVERFIT = 0.10
MILD_OVERFIT = 0.05
# --- end of fixed values ----------------------------------------------------

COMPARISON_COLUMNS = ("train_roc_auc", "test_roc_auc", "test_accuracy", "test_precision", "test_recall",
                      "test_f1", "cv_mean", "cv_std", "overfit")


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0 on an empty denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def class_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """The four cells as columns, one row per group."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Always four rows (by..., actual, predicted, n) for a group."""
    return _cells(class_counts(df, label, prediction, by), by)


def _cells(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    return counts.select(*by, F.inline(cells))


def score_columns() -> dict[str, Column]:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return {
        "accuracy": _ratio(tp + tn, tp + fp + tn + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def class_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """A17."""
    return class_counts(df, label, prediction, by).select(*by, *[e.alias(n) for n, e in score_columns().items()])


def class_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, then the averages."""
    return _lines(class_counts(df, label, prediction, by), by)


def _lines(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    total = tp + fp + tn + fn

    def line(name, precision, recall, f1, support):
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.alias("support"))

    ones = (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn))
    zeros = (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fp + fn))
    macro = [(a + b) / 2 for a, b in zip(zeros, ones)]
    weighted = [_ratio(a * (tn + fp) + b * (tp + fn), total) for a, b in zip(zeros, ones)]
    accuracy = _ratio(tp + tn, total)
    lines = F.array(line("0", *zeros, tn + fp), line("1", *ones, tp + fn),
                    line("accuracy", accuracy, accuracy, accuracy, total),
                    line("macro avg", *macro, total), line("weighted avg", *weighted, total))
    return counts.select(*by, F.inline(lines))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
            single_pass_rows: int = SINGLE_PASS_ROWS) -> DataFrame:
    """Exact area under the curve, ties counted half; null with one class only.

    Rows collapse to one per distinct score before anything is ordered, and
    the ordering is spread over range slices.
    """
    group = list(by) or ["_all"]
    rows = df if by else df.withColumn("_all", F.lit(0))
    per_score = rows.groupBy(*group, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    ranked = running_totals(per_score, group, ["_score"], ["neg"], single_pass_rows)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    area = F.try_divide(F.sum(pos * (F.col("neg_before") + neg / 2)), F.sum(pos) * F.sum(neg))
    return ranked.groupBy(*group).agg(area.alias("roc_auc")).select(*by, "roc_auc")


def evaluate(scored: DataFrame, label: str, prediction: str, score: str, by: Sequence[str],
             single_pass_rows: int = SINGLE_PASS_ROWS) -> DataFrame:
    """(by..., accuracy, precision, recall, f1, roc_auc): one row per group, e.g. model and split.

    The scored rows are read once: counts per distinct score feed both the
    class metrics and the area under the curve.
    """
    return metrics_of_counts(score_counts(scored, label, prediction, score, by), by, single_pass_rows)


def score_counts(scored: DataFrame, label: str, prediction: str, score: str, by: Sequence[str]) -> DataFrame:
    """Labels and hits per group and distinct score."""
    y, p = F.col(label), F.col(prediction)
    return scored.groupBy(*by, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"),
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def _summed(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return counts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "tn", "fn")])


def confusion_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A16 from :func:`score_counts`."""
    return _cells(_summed(counts, by), by)


def report_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A19 from :func:`score_counts`."""
    return _lines(_summed(counts, by), by)


def metrics_of_counts(per_score: DataFrame, by: Sequence[str], single_pass_rows: int = SINGLE_PASS_ROWS) -> DataFrame:
    """A17 and A18 from :func:`score_counts`."""
    ranked = running_totals(per_score, by, ["_score"], ["neg"], single_pass_rows)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    totals = ranked.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "tn", "fn")],
        F.try_divide(F.sum(pos * (F.col("neg_before") + neg / 2)), F.sum(pos) * F.sum(neg)).alias("roc_auc"))
    return totals.select(*by, *[e.alias(n) for n, e in score_columns().items()], "roc_auc")


def overfit_level(train_auc: Column, test_auc: Column) -> Column:
    """M9."""
    gap = train_auc - test_auc
    return F.when(gap > SEVERE_OVERFIT, "severe").when(gap > MILD_OVERFIT, "overfit").otherwise("ok")


def comparison_table(metrics: DataFrame, cv: DataFrame | None = None, sort_by: str = "test_roc_auc") -> DataFrame:
    """T1 + T2 from (model, split, accuracy, ..., roc_auc) rows and optional (model, cv_mean, cv_std)."""
    def of(split: str, column: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(column)))

    table = metrics.groupBy("model").agg(
        of("train", "roc_auc").alias("train_roc_auc"), of("test", "roc_auc").alias("test_roc_auc"),
        of("test", "accuracy").alias("test_accuracy"), of("test", "precision").alias("test_precision"),
        of("test", "recall").alias("test_recall"), of("test", "f1").alias("test_f1"))
    if cv is None:
        nothing = F.lit(None).cast("double")
        table = table.withColumns({"cv_mean": nothing, "cv_std": nothing})
    else:
        table = table.join(cv, "model", "left")
    table = table.withColumn("overfit", F.col("train_roc_auc") - F.col("test_roc_auc"))
    table = table.select("model", *COMPARISON_COLUMNS)
    return table.orderBy(F.col(sort_by).desc_nulls_last()) if sort_by in table.columns else table


def best_model(comparison: DataFrame, by: str = "test_roc_auc") -> DataFrame:
    """On a tie the model whose name comes first."""
    best = F.min(F.struct((-F.col(by)).alias("order"), F.col("model"))).alias("best")
    return comparison.where(F.col(by).isNotNull()).agg(best, F.max(by).alias(by)).select(F.col("best.model").alias("model"), by)


def comparison_schema() -> str:
    return ", ".join(["model string", *(f"{c} double" for c in COMPARISON_COLUMNS)])
