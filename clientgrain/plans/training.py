"""Fit, score, compare."""

from __future__ import annotations

import logging
import statistics
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract
from ..operators import metrics as MT
from ..operators.routing import ENCODER_SEED, FEATURES, FeatureLists, feature_names, fit_stages, preprocessing, preprocessing_kind
from ..operators.splits import stratified_folds, train_and_test
from ..session import cut, shared_folder
from .models import model_names, spec_for, with_training_columns

log = logging.getLogger(__name__)

SCORE = "score"
PREDICTION = "prediction"


@dataclass
class Trained:
    name: str
    model: PipelineModel
    features: list[str]
    metrics: DataFrame | None = None          # (model, split, accuracy, precision, recall, f1, roc_auc)
    confusion: DataFrame | None = None
    report: DataFrame | None = None
    counts: DataFrame | None = None           # labels and hits per model, split and distinct score
    cv: DataFrame | None = None               # (model, cv_mean, cv_std, cv_scores)


@dataclass
class Prepared:
    """A fitted preprocessing and the vectors of the rows it was fitted on."""

    stages: PipelineModel
    rows: DataFrame                           # (row id, label, features)
    features: list[str]


def prepare(name: str, train: DataFrame, lists: FeatureLists | None = None, label: str = contract.TARGET_COLUMN,
            row_id: str = contract.ID_COLUMN, row_features: bool = False, encoder_seed: int = ENCODER_SEED) -> Prepared:
    """The preprocessing of a model, fitted on the training rows; models of one kind can share it.

    The vectors are stored: every classifier reads them several times before it holds them in its own form.
    """
    lists = lists or FeatureLists.from_contract(train)
    # Derived row features need their raw inputs; otherwise only listed columns are read.
    wanted = set(train.columns if row_features else lists.all()) - {row_id, label}
    needed = train.select(row_id, label, *[c for c in train.columns if c in wanted])
    stages, prepared = fit_stages(preprocessing(name, needed, lists, label, row_id, row_features, encoder_seed=encoder_seed), needed)
    return Prepared(stages, cut(prepared.select(row_id, label, FEATURES)), feature_names(prepared))


def fit(name: str, train: DataFrame, lists: FeatureLists | None = None, label: str = contract.TARGET_COLUMN,
        row_id: str = contract.ID_COLUMN, row_features: bool = False, encoder_seed: int = ENCODER_SEED,
        prepared: Prepared | None = None, **overrides) -> Trained:
    """Preprocessing and classifier, fitted on the training rows only; ``prepared`` is a preprocessing of them that is there already."""
    spec = spec_for(name)
    shared_folder(train.sparkSession)         # boosted trees cut their lineage there
    prepared = prepared or prepare(name, train, lists, label, row_id, row_features, encoder_seed)
    rows = prepared.rows.count() if spec.needs_rows else 0
    params = {**spec.params, **overrides}
    fitted = spec.build(rows, label, params).fit(with_training_columns(prepared.rows, spec, label, row_id))
    return Trained(name, PipelineModel([*prepared.stages.stages, fitted]), prepared.features)


def scored(trained: Trained, df: DataFrame, keep: Sequence[str], as_probability: bool = False) -> DataFrame:
    """(keep..., prediction, score) for every row; the score orders the rows, or is a probability."""
    out = trained.model.transform(df)
    spec = spec_for(trained.name)
    value = (spec.probability or spec.score)() if as_probability else spec.score()
    return out.select(*keep, F.col(PREDICTION).cast("int").alias(PREDICTION), value.alias(SCORE))


def train(name: str, train_rows: DataFrame, test_rows: DataFrame, lists: FeatureLists | None = None,
          label: str = contract.TARGET_COLUMN, row_id: str = contract.ID_COLUMN, prepared: Prepared | None = None, **overrides) -> Trained:
    """M6: fit, then score both splits once each."""
    trained = fit(name, train_rows, lists, label, row_id, prepared=prepared, **overrides)
    on_train = scored(trained, train_rows, [label]).withColumn("split", F.lit("train"))
    on_test = scored(trained, test_rows, [label])
    both = on_train.unionByName(on_test.withColumn("split", F.lit("test"))).withColumn("model", F.lit(name))
    # The splits are scored once: everything else is derived from counts per score.
    counts = cut(MT.score_counts(both, label, PREDICTION, SCORE, ["model", "split"]))
    trained.counts = counts
    trained.metrics = MT.metrics_of_counts(counts, ["model", "split"])
    of_test = counts.where(F.col("split") == "test")
    trained.confusion = MT.confusion_of_counts(of_test)
    trained.report = MT.report_of_counts(of_test)
    return trained


def cross_validate(name: str, df: DataFrame, lists: FeatureLists | None = None, folds: int = contract.CV_FOLDS,
                   label: str = contract.TARGET_COLUMN, row_id: str = contract.ID_COLUMN, parallelism: int = 2,
                   **overrides) -> DataFrame:
    """M8: one row (model, cv_mean, cv_std, cv_scores); everything is refitted in each fold.

    Folds are independent jobs, so a few run at a time from driver threads.
    Each draws the folds of its encoder with a seed of its own.
    """
    flagged = stratified_folds(df, row_id, label, folds, output="_fold")

    def one(fold: int) -> float:
        trained = fit(name, flagged.where(F.col("_fold") != fold).drop("_fold"), lists, label, row_id,
                      encoder_seed=ENCODER_SEED + 1 + fold, **overrides)
        held = scored(trained, flagged.where(F.col("_fold") == fold).drop("_fold"), [label])
        return MT.roc_auc(held, label, SCORE).first()["roc_auc"]

    with ThreadPool(min(parallelism, folds)) as pool:
        scores = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
    known = [s for s in scores if s is not None]
    row = (name, statistics.fmean(known) if known else None, statistics.pstdev(known) if known else None, scores)
    return df.sparkSession.createDataFrame([row], "model string, cv_mean double, cv_std double, cv_scores array<double>")


def train_many(df: DataFrame, names: Sequence[str] | None = None, run_cv: bool = False, save_to: str | None = None,
               overrides: dict[str, dict] | None = None, lists: FeatureLists | None = None,
               label: str = contract.TARGET_COLUMN, row_id: str = contract.ID_COLUMN) -> tuple[dict[str, Trained], DataFrame]:
    """Train the named models on one split; a failing one is recorded and skipped.

    Models of one kind of preprocessing share it.  Returns the trained models
    and (model, status, error) rows.
    """
    train_rows, test_rows = train_and_test(df, row_id=row_id, label=label)
    done: dict[str, Trained] = {}
    shared: dict[str, Prepared] = {}
    outcomes = []
    for name in names or model_names():
        try:
            options = (overrides or {}).get(name, {})
            cv = cross_validate(name, train_rows, lists, label=label, row_id=row_id, **options) if run_cv else None
            spec_for(name)
            kind = preprocessing_kind(name)
            if kind not in shared:
                shared[kind] = prepare(name, train_rows, lists, label, row_id)
            trained = train(name, train_rows, test_rows, lists, label, row_id, shared[kind], **options)
            trained.cv = cv
            if save_to:
                save(trained, f"{save_to}/{name}")
            done[name] = trained
            outcomes.append((name, "trained", None))
        except Exception as error:  # the other models must still be trained
            log.error("failed: %s - %r", name, error)
            outcomes.append((name, "failed", repr(error)))
    return done, df.sparkSession.createDataFrame(outcomes, "model string, status string, error string")


def compare(trained: dict[str, Trained], sort_by: str = "test_roc_auc") -> DataFrame:
    """T1-T2 over trained models; no rows if there are none."""
    if not trained:
        return SparkSession.active().createDataFrame([], MT.comparison_schema())
    parts = [t.metrics for t in trained.values()]
    metrics = parts[0]
    for part in parts[1:]:
        metrics = metrics.unionByName(part)
    cvs = [t.cv.select("model", "cv_mean", "cv_std") for t in trained.values() if t.cv is not None]
    cv = None
    for part in cvs:
        cv = part if cv is None else cv.unionByName(part)
    return MT.comparison_table(metrics, cv, sort_by)


def quick_fit(df: DataFrame, name: str = "lightgbm", lists: FeatureLists | None = None, label: str = contract.TARGET_COLUMN,
              row_id: str = contract.ID_COLUMN, test_size: float = contract.QUICK_TEST_SIZE, **overrides) -> tuple[Trained, DataFrame]:
    """The model and one row (model, train_score, val_score) of accuracies."""
    if label not in df.columns:
        raise ValueError(f"the table to learn from has no label {label!r}")
    train_rows, held = train_and_test(df, row_id=row_id, label=label, test_size=test_size)
    trained = train(name, train_rows, held, lists, label, row_id, **overrides)
    accuracy = trained.metrics.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("accuracy"))).alias("train_score"),
        F.max(F.when(F.col("split") == "test", F.col("accuracy"))).alias("val_score"))
    return trained, accuracy


def save(trained: Trained, path: str) -> None:
    """The fitted stages and, if there are any, the metrics."""
    trained.model.write().overwrite().save(f"{path}/model")
    if trained.metrics is not None:
        trained.metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def load(spark: SparkSession, name: str, path: str) -> Trained:
    model = PipelineModel.load(f"{path}/model")
    try:
        metrics = spark.read.parquet(f"{path}/metrics")
    except AnalysisException:
        metrics = None
    assembler = next(s for s in model.stages if s.hasParam("outputCol") and s.getOrDefault("outputCol") == FEATURES)
    return Trained(name, model, assembler.slots(), metrics)
