"""Packed columns, staged boosting, linear importance and expressions, against plain computations."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clientgrain.operators import encoders as E
from clientgrain.operators import packed as P
from clientgrain.operators.quantiles import melt
from clientgrain.operators.routing import FeatureLists
from clientgrain.plans import boosting as B
from clientgrain.plans import expressions as X
from clientgrain.plans import selection as SE
from clientgrain.plans import training as TR

ID, Y = "SK_ID_CURR", "TARGET"
LISTS = FeatureLists(("a", "b", "c", "never"), ("kind",), ("flag",))


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    out = []
    for i in range(800):
        a, kind = float(r.normal()), str(r.choice(["x", "Y", "it's"]))
        p = 1 / (1 + np.exp(-(2 * a + (1.5 if kind == "x" else -0.5))))
        out.append((i, int(r.random() < p), None if i % 13 == 0 else a, float(np.exp(r.normal() * 2)), float(r.integers(0, 3)), None,
                    None if i % 17 == 0 else kind, None if i % 5 == 0 else int(r.integers(0, 2))))
    return spark.createDataFrame(out, f"{ID} long, {Y} int, a double, b double, c double, never double, kind string, flag int").cache()


def test_packed_equals_column_by_column(rows):
    cols = ["a", "b", "c", "never"]
    model = P.PackedScaling(inputCols=cols, outputCol="x").fit(rows)
    packed = model.transform(rows).select(ID, *[F.col("x")[i].alias(c) for i, c in enumerate(cols)])
    df = rows.select(ID, *cols)
    for stage in (E.MedianImputer, E.PowerTransform, E.RobustScaling):
        df = stage(inputCols=cols).fit(df).transform(df)
    both = packed.join(df.withColumnsRenamed({c: f"other_{c}" for c in cols}), ID)
    for c in cols:
        assert both.where(F.abs(F.col(c) - F.col(f"other_{c}")) > 1e-9).isEmpty() and both.where(f"{c} IS NULL").isEmpty()
    modes = P.PackedModes(inputCols=["flag", "never"], outputCol="m").fit(rows)
    assert modes.getOrDefault(modes.learned)["mode"] == [E.ModeImputer(inputCols=["flag"]).fit(rows).getOrDefault("learned")["flag"], 0.0]


def test_the_plan_does_not_grow_with_the_columns(spark):
    def size(n):
        df = spark.range(3).select("id", *[(F.col("id") * i).cast("double").alias(f"n{i}") for i in range(n)])
        names = [f"n{i}" for i in range(n)]
        of = {k: [1.0] * n for k in ("median", "power", "mean", "deviation", "center", "scale")}
        plan = P.PackedScalingModel(inputCols=names, outputCol="x", learned=of).transform(df)._jdf.queryExecution().optimizedPlan()
        return plan.toString().count("log1p")
    assert size(5) == size(50)


def test_a_null_feature_fails(spark):
    df = spark.createDataFrame([(1, [1.0, None])], "id int, x array<double>")
    with pytest.raises(Exception, match="a feature is null"):
        P.PackedAssembler(inputCols=["x"], outputCol="v", packed={"x": ["p", "q"]}).transform(df).collect()


def test_powers_take_four_scans_and_are_peaks(rows, monkeypatch):
    scans = []
    for name in ("_constants", "_digests", "_likelihoods"):
        whole = getattr(E, name)
        monkeypatch.setattr(E, name, lambda *a, _f=whole, _n=name: (scans.append(_n), _f(*a))[1])
    cols = ["a", "b", "c"]
    powers = E.fit_powers(rows, cols)
    assert len(scans) <= 4
    long = melt(rows, cols).where("value IS NOT NULL")
    constants = E._constants(long)
    grids = {c: [p + 0.01 * i for i in range(-E.GRID_HALF, E.GRID_HALF + 1)] for c, p in powers.items()}
    for scores in E._likelihoods(long, grids, constants).values():
        assert scores[E.GRID_HALF] >= max(scores) - 1e-6


def test_a_tree_is_read_from_its_text(spark):
    from pyspark.ml.regression import DecisionTreeRegressor
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 3))
    df = spark.createDataFrame([(Vectors.dense(v), float(v[0] * v[1] + (v[2] > 0))) for v in x], ["features", "label"])
    model = DecisionTreeRegressor(maxDepth=5).fit(df)
    total = B.sums_of([B.parsed(model.toDebugString)])
    assert total(x) == pytest.approx([p[0] for p in model.transform(df).select("prediction").collect()], abs=1e-12)
    assert B.parsed("  Predict: 0.25") == {"feature": [-1], "threshold": [0.0], "left": [0], "right": [0], "value": [0.25]}


def vectors(rows):
    return TR.prepare("logistic_regression", rows, LISTS).rows


OPTIONS = {"maxIter": 200, "stepSize": 0.5, "maxDepth": 3, "seed": 1}


def test_patience_ends_growth(rows):
    held = vectors(rows).withColumn("held", F.col(ID) % 4 == 0)
    model = B.BoostedTrees(labelCol=Y, validationCol="held", options={**OPTIONS, "patience": 20}).fit(held)
    losses = model.getOrDefault(model.losses)
    assert losses[-1][0] < 200 and losses[-1][0] - min(losses, key=lambda s: s[1])[0] == 20
    assert model.getNumTrees == min(losses, key=lambda s: s[1])[0]
    # The noted loss is that of the kept trees on the held rows.
    p = model.transform(held.where("held")).select(F.expr(Y).alias("y"), "probability").collect()
    mine = -np.mean([np.log(r.probability[r.y]) for r in p])
    assert mine == pytest.approx(min(s[1] for s in losses), rel=1e-9)


def test_an_interrupted_run_goes_on(rows, tmp_path, monkeypatch):
    data = vectors(rows)
    whole = B.BoostedTrees(labelCol=Y, options={**OPTIONS, "maxIter": 30}, folder=str(tmp_path / "a")).fit(data)
    stored, blocks = B.BoostedTrees._stored, []

    def stops(self, frame, folder, trees, *rest, **options):
        blocks.append(len(trees))
        if len(trees) == 20:
            raise KeyboardInterrupt
        return stored(self, frame, folder, trees, *rest, **options)
    monkeypatch.setattr(B.BoostedTrees, "_stored", stops)
    estimator = B.BoostedTrees(labelCol=Y, options={**OPTIONS, "maxIter": 30}, folder=str(tmp_path / "b"))
    with pytest.raises(KeyboardInterrupt):
        estimator.fit(data)
    monkeypatch.setattr(B.BoostedTrees, "_stored", stored)
    again = estimator.fit(data)
    assert blocks == [0, 10, 20] and again.getNumTrees == 30
    assert again.getOrDefault(again.trees)[:10] == whole.getOrDefault(whole.trees)[:10]


def test_nothing_to_grow_on(rows):
    with pytest.raises(ValueError, match="no rows"):
        B.BoostedTrees(labelCol=Y, options=OPTIONS).fit(vectors(rows).limit(0))


@pytest.mark.parametrize("name, options", [("logistic_regression", {"max_iter": 30}), ("sgd_classifier", {"max_iter": 30}),
                                           ("xgboost", {"n_estimators": 4, "learning_rate": 0.3}), ("catboost", {"n_estimators": 10, "learning_rate": 0.3})])
def test_an_expression_scores_alike_in_both_engines(spark, rows, tmp_path, name, options):
    trained = TR.fit(name, rows, LISTS, **options)
    stages = {r[ID]: r.score for r in TR.scored(trained, rows, [ID], as_probability=True).collect()}
    by_text = {r[ID]: r.probability for r in X.score_by_expression(rows, trained, [ID]).collect()}
    rows.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    elsewhere = dict(con.execute(f"SELECT {ID}, {X.probability_expression(trained)} FROM read_parquet('{tmp_path}/rows/*.parquet')").fetchall())
    assert len(stages) == 800 and set(stages) == set(by_text) == set(elsewhere)
    for i, p in stages.items():
        assert by_text[i] == pytest.approx(p, abs=1e-9) and elsewhere[i] == pytest.approx(p, abs=1e-9)


def test_confusion_and_area_from_the_other_engine(spark, rows, tmp_path):
    """M6: the evaluation's cells and area are those of scores computed without Spark."""
    train_rows, test_rows = rows.where(F.col(ID) % 3 != 0), rows.where(F.col(ID) % 3 == 0)
    trained = TR.train("logistic_regression", train_rows, test_rows, LISTS, max_iter=30)
    test_rows.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE s AS SELECT {Y} AS y, {X.probability_expression(trained)} AS p FROM read_parquet('{tmp_path}/rows/*.parquet')")
    cells = con.execute("SELECT count(*) FILTER (y = 1 AND p > 0.5), count(*) FILTER (y = 0 AND p > 0.5), count(*) FILTER (y = 0 AND p <= 0.5), count(*) FILTER (y = 1 AND p <= 0.5) FROM s").fetchone()
    area = con.execute("SELECT avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END) FROM s a, s b WHERE a.y = 1 AND b.y = 0").fetchone()[0]
    row = TR.MT._summed(trained.counts, ["model", "split"]).where("split = 'test'").first()
    assert (row.tp, row.fp, row.tn, row.fn) == cells
    assert trained.metrics.where("split = 'test'").first().roc_auc == pytest.approx(area, abs=1e-9)


def test_linear_importance_equals_rescoring(rows):
    trained = TR.fit("logistic_regression", rows, LISTS, max_iter=30)
    data = TR.PipelineModel(trained.model.stages[:-1]).transform(rows)
    model, score = trained.model.stages[-1], TR.spec_for("logistic_regression").score()
    fast = {r.feature: r for r in SE.permutation_importance(model, data, trained.features, score, repeats=2).collect()}
    whole = SE.linear_weights
    SE.linear_weights = lambda m: None
    try:
        slow = {r.feature: r for r in SE.permutation_importance(model, data, trained.features, score, repeats=2).collect()}
    finally:
        SE.linear_weights = whole
    assert set(fast) == set(slow) == set(trained.features)
    for f, r in fast.items():
        assert r.importance == pytest.approx(slow[f].importance, abs=1e-9) and r.importance_std == pytest.approx(slow[f].importance_std, abs=1e-9)
