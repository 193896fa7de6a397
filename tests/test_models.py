"""Models are checked on a planted signal."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clientgrain.operators.routing import FeatureLists
from clientgrain.operators.splits import train_and_test
from clientgrain.plans import models as MO
from clientgrain.plans import selection as SE
from clientgrain.plans import training as TR
from clientgrain.plans.scoring import check_records, score

ID, Y = "SK_ID_CURR", "TARGET"
LISTS = FeatureLists(("EXT_SOURCE_2", "AMT_CREDIT", "DAYS_BIRTH"), ("CODE_GENDER",), ("FLAG_PHONE",))
SMALL = {"logistic_regression": {"max_iter": 30}, "random_forest": {"n_estimators": 10, "min_samples_leaf": 10},
         "sgd_classifier": {"max_iter": 30}, "lightgbm": {"n_estimators": 5, "learning_rate": 0.1},
         "xgboost": {"n_estimators": 5, "learning_rate": 0.1}, "catboost": {"n_estimators": 5, "learning_rate": 0.1, "max_depth": 3}}


@pytest.fixture(scope="module")
def planted(spark):
    r = np.random.default_rng(9)
    rows = []
    for i in range(1200):
        s, gender = float(r.random()), str(r.choice(["F", "M"]))
        p = 1 / (1 + np.exp(-(6 * (0.5 - s) + (1.0 if gender == "M" else -1.0) - 1)))
        rows.append((i, int(r.random() < p), None if i % 19 == 0 else s, float(r.integers(1, 1000)),
                     int(-r.integers(7000, 20000)), gender, int(r.integers(0, 2))))
    df = spark.createDataFrame(rows, f"{ID} long, {Y} int, EXT_SOURCE_2 double, AMT_CREDIT double, DAYS_BIRTH int, CODE_GENDER string, FLAG_PHONE int")
    return df.cache()


@pytest.mark.parametrize("name", list(MO.MODELS))
def test_signal_is_found(planted, name):
    train_rows, test_rows = train_and_test(planted)
    trained = TR.train(name, train_rows, test_rows, LISTS, **SMALL[name])
    auc = {r.split: r.roc_auc for r in trained.metrics.collect()}
    assert auc["test"] > 0.75 and auc["train"] > 0.75
    assert trained.confusion.agg(F.sum("n")).first()[0] == test_rows.count()
    assert trained.report.count() == 5


def test_own_auc_equals_the_evaluator(planted):
    train_rows, test_rows = train_and_test(planted)
    trained = TR.train("logistic_regression", train_rows, test_rows, LISTS, max_iter=20)
    full = trained.model.transform(test_rows)
    theirs = BinaryClassificationEvaluator(labelCol=Y, numBins=0).evaluate(full)
    mine = {r.split: r.roc_auc for r in trained.metrics.collect()}["test"]
    assert mine == pytest.approx(theirs, rel=1e-9)


def test_cross_validation(planted):
    row = TR.cross_validate("logistic_regression", planted, LISTS, folds=3, max_iter=10).first()
    assert len(row.cv_scores) == 3 and row.cv_mean == pytest.approx(np.mean(row.cv_scores))
    assert row.cv_std == pytest.approx(np.std(row.cv_scores)) and row.cv_mean > 0.75


def test_unknown_and_failing_models(planted):
    with pytest.raises(ValueError, match="no model is registered as"):
        MO.spec_for("nothing")
    done, status = TR.train_many(planted, ["logistic_regression", "nothing"], lists=LISTS, overrides=SMALL)
    assert {r.model: r.status for r in status.collect()} == {"logistic_regression": "trained", "nothing": "failed"}
    table = TR.compare(done)
    assert table.columns[0] == "model" and table.count() == 1


def test_positive_weight_and_validation_slice(planted):
    spec = MO.MODELS["catboost"]
    out = MO.with_training_columns(planted, spec, Y, ID)
    weights = {r[Y]: r["w"] for r in out.groupBy(Y).agg(F.max(MO.WEIGHT).alias("w")).collect()}
    assert weights == {0: 1.0, 1: 15.0}
    assert 0.05 < out.agg(F.avg(F.col(MO.VALIDATION).cast("int"))).first()[0] < 0.15


def test_importance_finds_the_signal(planted):
    train_rows, test_rows = train_and_test(planted)
    trained = TR.train("logistic_regression", train_rows, test_rows, LISTS, max_iter=20)
    table = SE.importance_of(trained, test_rows, repeats=2, bucket_rows=50)
    ranked = [r.feature for r in table.collect()]
    assert set(ranked[:2]) == {"EXT_SOURCE_2", "CODE_GENDER"} and len(ranked) == 5
    kept = SE.select_features(table, 0.02).collect()
    assert [r["rank"] for r in kept] == [1, 2]


def test_importance_does_not_depend_on_cells(planted, monkeypatch):
    """Margins ordered in many cells give what one cell gives."""
    train_rows, test_rows = train_and_test(planted)
    trained = TR.fit("logistic_regression", train_rows, LISTS, max_iter=20)
    whole = SE.importance_of(trained, test_rows, repeats=2).collect()
    monkeypatch.setattr(SE, "CELL_ROWS", 20)
    assert SE.importance_of(trained, test_rows, repeats=2).collect() == whole


def test_prepared_vectors_are_stored(planted, capsys):
    """A classifier that reads the vectors again does not prepare them again."""
    TR.prepare("logistic_regression", planted, LISTS).rows.explain()
    plan = capsys.readouterr().out
    assert "Existing RDD" in plan or "ExistingRDD" in plan
    assert "Join" not in plan and "EvalPython" not in plan


def test_donors_are_a_permutation(spark):
    base = spark.range(1000).select(F.col("id").alias(ID), F.array(F.col("id").cast("double")).alias("x"))
    out = SE._with_donors(base, ID, 7, 42).select(F.col("x")[0].alias("own"), F.col("donor")[0].alias("other"))
    assert out.select("other").distinct().count() == 1000
    assert out.where("own = other").isEmpty()


def test_saved_model_scores_the_same(spark, planted, tmp_path):
    train_rows, test_rows = train_and_test(planted)
    trained = TR.train("xgboost", train_rows, test_rows, LISTS, **SMALL["xgboost"])
    TR.save(trained, str(tmp_path / "m"))
    loaded = TR.load(spark, "xgboost", str(tmp_path / "m"))
    first, second = (score(test_rows, t) for t in (trained, loaded))
    assert first.exceptAll(second).isEmpty() and loaded.features == trained.features
    assert loaded.metrics.exceptAll(trained.metrics).isEmpty()


def test_quick_fit(planted):
    trained, row = TR.quick_fit(planted, lists=LISTS, **SMALL["lightgbm"])
    assert row.columns == ["model", "train_score", "val_score"] and row.count() == 1
    with pytest.raises(ValueError):
        TR.quick_fit(planted.drop(Y), lists=LISTS)


def test_scores_use_the_given_threshold(planted):
    trained = TR.fit("logistic_regression", planted, LISTS, max_iter=10)
    out = score(planted, trained, threshold=0.3)
    assert out.columns == [ID, "model_name", "prediction", "probability", "threshold"]
    assert out.where("prediction != cast(probability >= 0.3 as int) or threshold != 0.3").isEmpty()


def test_stream_equals_batch(spark, planted, tmp_path):
    from clientgrain.streaming.scoring import application_stream, run_available
    trained = TR.fit("logistic_regression", planted, LISTS, max_iter=10)
    incoming = str(tmp_path / "in")
    planted.repartition(3).write.parquet(incoming)
    stream = application_stream(spark, incoming, planted.schema, files_per_batch=1)
    paths = str(tmp_path / "out"), str(tmp_path / "progress")
    out = run_available(stream, lambda s: score(s, trained), *paths)
    batch = score(planted, trained)
    assert out.exceptAll(batch).isEmpty() and batch.exceptAll(out).isEmpty()
    # Starting again reads nothing twice.
    again = run_available(application_stream(spark, incoming, planted.schema), lambda s: score(s, trained), *paths)
    assert again.count() == planted.count()


def test_registered_stream_and_batch_scores_agree(spark, tiny):
    from clientgrain import catalog
    from clientgrain.operators.history import aggregate_histories
    from clientgrain.sources import roles
    catalog.load()
    from clientgrain.catalog.models import saved_model
    from clientgrain.catalog.streams import streamed_scores
    tables = roles.loan_tables(spark, tiny)
    whole = score(tables["application"], saved_model(spark, tiny, "logistic_regression"), aggregate_histories(tables))
    batch, stream = (d.select(ID, "prediction", F.round("probability", 9).alias("p"))
                     for d in (whole, streamed_scores(spark, tiny, "logistic_regression")))
    assert batch.count() == 150 and batch.exceptAll(stream).isEmpty() and stream.exceptAll(batch).isEmpty()


def test_histories_are_aggregated_once(spark, tiny, monkeypatch):
    """Training and scoring on a stream share the stored histories."""
    from clientgrain import catalog
    from clientgrain.operators import history
    catalog.load()
    from clientgrain.catalog import models, streams
    made, lists = [], FeatureLists(LISTS.numerical, LISTS.categorical, ("FLAG_DOCUMENT_3",))
    aggregate = history.aggregate_histories
    monkeypatch.setattr(history, "aggregate_histories", lambda *a, **k: made.append(1) or aggregate(*a, **k))
    monkeypatch.setattr("clientgrain.plans.feature_store.aggregate_histories", history.aggregate_histories)
    monkeypatch.setattr(models, "_shared", {})
    monkeypatch.setattr(models, "_stores", {})
    monkeypatch.setattr(streams, "saved_model", lambda spark, sf_dir, name: TR.fit("logistic_regression", models.stored(spark, sf_dir), lists, max_iter=3))
    assert streams.streamed_scores(spark, tiny, "logistic_regression").count() == 150
    assert made == [1]


def test_request_contract(spark):
    from clientgrain.sources.schemas import scoring_record_schema
    schema = scoring_record_schema()
    assert len(schema) == 17 and sum(f.nullable for f in schema) == 4
    good = {f.name: "1" for f in schema if not f.nullable}
    bad = {**good, "AMT_CREDIT": "not a number", "CODE_GENDER": None}
    df = spark.createDataFrame([good, bad], ", ".join(f"{n} string" for n in good))
    accepted, rejected = check_records(df)
    assert accepted.count() == 1 and set(accepted.columns) == set(schema.names)
    assert sorted(rejected.first()["problems"]) == ["AMT_CREDIT", "CODE_GENDER"]


@pytest.mark.parametrize("name", list(MO.MODELS))
def test_every_model_scores_probabilities(planted, name):
    trained = TR.fit(name, planted, LISTS, **SMALL[name])
    low, high = score(planted, trained).agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= low < high <= 1


def test_an_error_without_text_is_recorded(planted, monkeypatch):
    monkeypatch.setattr(TR, "train", lambda *a, **k: (_ for _ in ()).throw(RuntimeError()))
    done, status = TR.train_many(planted, ["logistic_regression"], lists=LISTS)
    assert [tuple(r) for r in status.collect()] == [("logistic_regression", "failed", "RuntimeError()")]
    table = TR.compare(done)
    assert table.columns == ["model", *TR.MT.COMPARISON_COLUMNS] and table.count() == 0


def test_features_without_weight_lose_nothing(planted):
    """A model that never looks at a feature is scored on the others only."""
    train_rows, test_rows = train_and_test(planted.withColumn("AMT_CREDIT", F.lit(1.0)))
    trained = TR.fit("random_forest", train_rows, LISTS, **SMALL["random_forest"])
    table = {r.feature: (r.importance, r.importance_std) for r in SE.importance_of(trained, test_rows, repeats=2).collect()}
    assert table["AMT_CREDIT"] == (0.0, 0.0) and table["EXT_SOURCE_2"][0] > 0.02


def test_the_comparison_trains_with_the_published_parameters(planted, monkeypatch):
    """Every model of the catalogue is built with the parameters it is registered with, trees and patience included."""
    from clientgrain import catalog
    catalog.load()
    from clientgrain.catalog import models
    built = {}
    for name, spec in MO.MODELS.items():
        monkeypatch.setitem(MO.MODELS, name, replace(spec, build=lambda rows, label, params, _n=name, _s=spec: (built.__setitem__(_n, dict(params)), _s.build(rows, label, {**params, "max_iter": 3, "n_estimators": 1, "max_depth": 2}))[1]))
    monkeypatch.setattr(models, "_shared", {})
    monkeypatch.setattr(models, "split_rows", lambda spark, sf_dir: train_and_test(planted))
    monkeypatch.setattr(models, "_lists", lambda df: LISTS)
    table = models.train_and_compare(planted.sparkSession, "planted")
    assert {r.model: r.overfit_follows for r in table.collect()} == dict.fromkeys(MO.MODELS, True)
    assert built == {name: spec.params for name, spec in MO.MODELS.items()}
    assert [built[n]["n_estimators"] for n in ("lightgbm", "xgboost", "catboost")] == [5000, 3000, 3000] and built["catboost"]["patience"] == 300
