import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clientgrain.operators import encoders as E
from clientgrain.operators import routing as R
from clientgrain.operators.splits import plain_folds

ID, Y = "SK_ID_CURR", "TARGET"


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({
        ID: np.arange(n), Y: r.integers(0, 2, n), "num": r.exponential(5, n), "other": r.normal(0, 1, n),
        "cat": r.choice(["a", "b", "c"], n, p=[.6, .3, .1]), "rare": [f"r{i}" for i in r.integers(0, 200, n)],
        "flag": r.integers(0, 2, n).astype(float)})
    pdf.loc[::7, "num"] = None
    pdf.loc[::11, "cat"] = None
    pdf.loc[::5, "flag"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                               f"{ID} long, {Y} int, num double, other double, cat string, rare string, flag double")
    return pdf, df


def brute_force_oof(pdf, folds, col):
    filled = pdf[col].fillna("__NA__")
    out = []
    for i in range(len(pdf)):
        rest = (folds != folds.iloc[i]) & (filled == filled.iloc[i])
        out.append(pdf.loc[rest, Y].mean() if rest.any() else pdf[Y].mean())
    return np.array(out)


def test_cross_fitting(spark, data):
    pdf, df = data
    model = E.CrossFitEncoder(inputCols=["cat", "rare"]).fit(df)
    fold = {r[ID]: r.fold for r in plain_folds(df).collect()}
    folds = pdf[ID].map(fold)
    got = {r[ID]: r for r in E.encode_training(model, df).collect()}
    for c in ("cat", "rare"):
        expected = brute_force_oof(pdf, folds, c)
        assert np.allclose([got[i][c] for i in pdf[ID]], expected)
    full = {r[ID]: r for r in model.transform(df).collect()}
    means = pdf.groupby(pdf["cat"].fillna("__NA__"))[Y].mean()
    assert np.allclose([full[i]["cat"] for i in pdf[ID]], pdf["cat"].fillna("__NA__").map(means))


def test_own_label_never_counts(spark, data):
    pdf, df = data
    flipped = df.withColumn(Y, F.when(F.col(ID) == 17, 1 - F.col(Y)).otherwise(F.col(Y)))
    values = []
    for d in (df, flipped):
        model = E.CrossFitEncoder(inputCols=["cat"]).fit(d)
        values.append(E.encode_training(model, d).where(F.col(ID) == 17).first()["cat"])
    assert values[0] == values[1]


def test_unseen_categories_get_the_overall_mean(spark, data):
    pdf, df = data
    model = E.CrossFitEncoder(inputCols=["cat"]).fit(df)
    new = spark.createDataFrame([(1, "zzz")], f"{ID} long, cat string")
    assert model.transform(new).first()["cat"] == pytest.approx(pdf[Y].mean())
    with pytest.raises(ValueError):
        E.CrossFitEncoder(inputCols=["cat"]).fit(df.limit(0))


def test_imputers_and_scaling(data):
    pdf, df = data
    med = E.MedianImputer(inputCols=["num"]).fit(df)
    assert med.getOrDefault(med.learned)["num"] == pytest.approx(pdf["num"].median())
    mode = E.ModeImputer(inputCols=["flag"]).fit(df)
    assert mode.getOrDefault(mode.learned)["flag"] == pdf["flag"].mode()[0]
    scale = E.RobustScaling(inputCols=["other"]).fit(df)
    q = pdf["other"].quantile([.25, .5, .75]).tolist()
    assert scale.getOrDefault(scale.learned)["other"] == pytest.approx([q[1], q[2] - q[0]])


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,), (2.0,), (None,)], "v double")
    assert E.most_frequent(df, ["v"]).first()["value"] == 1.0


def test_columns_without_values(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0)], "id int, gone double, same double")
    filled = E.MedianImputer(inputCols=["gone", "same"]).fit(df).transform(df)
    bent = E.PowerTransform(inputCols=["gone", "same"]).fit(filled).transform(filled)
    scaled = E.RobustScaling(inputCols=["gone", "same"]).fit(bent).transform(bent)
    assert [tuple(r) for r in scaled.select("gone", "same").collect()] == [(0.0, 0.0)] * 2


def log_likelihood(x, power):
    pos = x >= 0
    out = np.empty_like(x)
    out[pos] = np.log1p(x[pos]) if power == 0 else ((x[pos] + 1) ** power - 1) / power
    out[~pos] = -np.log1p(-x[~pos]) if power == 2 else -((1 - x[~pos]) ** (2 - power) - 1) / (2 - power)
    return -len(x) / 2 * np.log(out.var()) + (power - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def test_powers_maximise_the_likelihood(spark):
    r = np.random.default_rng(0)
    columns = {"a": r.exponential(3, 800), "b": r.normal(0, 1, 800), "c": -r.lognormal(0, 1, 800)}
    df = spark.createDataFrame([tuple(map(float, row)) for row in zip(*columns.values())], list(columns))
    for c, power in E.fit_powers(df, list(columns)).items():
        best = log_likelihood(columns[c], power)
        for step in (0.3, 0.01, 1e-4):
            assert best >= log_likelihood(columns[c], power + step) and best >= log_likelihood(columns[c], power - step)


def test_powers_far_from_one_are_found(spark):
    """Values near 2000 with a slight skew: the best power lies beyond 30."""
    r = np.random.default_rng(4)
    x = 2000 * (1 + 0.002 * r.normal(0, 1, 4000)) ** (1 / 1.0)
    x = (x ** 35 + 0 * x) ** (1 / 35)
    x = np.sort(x) - 30 * r.gamma(2, 0.2, 4000).clip(0, 3)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    power = E.fit_powers(df, ["v"])["v"]
    best = log_likelihood(x, power)
    assert abs(power) > 30
    for step in (5.0, 0.5, 0.05):
        assert best >= log_likelihood(x, power + step) - 1e-6 and best >= log_likelihood(x, power - step) - 1e-6


def test_too_many_categories_for_one_hot(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_ONE_HOT", 3)
    train = spark.createDataFrame([(f"c{i}",) for i in range(5)], "c string")
    with pytest.raises(ValueError, match="more than 3 categories"):
        R.fit_stages(R.one_hot_stages(["c"]), train)


def test_one_hot_unseen_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    models, _ = R.fit_stages(R.one_hot_stages(["c"]), train)
    out = models.transform(spark.createDataFrame([("a",), ("new",), (None,)], "c string").coalesce(1))
    assert [r[0] for r in out.select(vector_to_array("c_vec")).collect()] == [[1, 0, 0], [0, 0, 0], [0, 0, 1]]


@pytest.mark.parametrize("name", ["logistic_regression", "catboost"])
def test_preprocessing_saves_and_names(spark, data, tmp_path, name):
    _, df = data
    lists = R.FeatureLists(("num", "other"), ("cat", "rare"), ("flag",))
    model, prepared = R.fit_stages(R.preprocessing(name, df, lists), df)
    names = R.feature_names(prepared)
    assert len(names) == 5 and "num" in names
    assert R.raw_inputs(model) == ["num", "other", "cat", "rare", "flag"]
    model.write().overwrite().save(str(tmp_path / name))
    loaded = PipelineModel.load(str(tmp_path / name))
    first, second = (m.transform(df).select(ID, vector_to_array(R.FEATURES).alias("x")) for m in (model, loaded))
    assert first.exceptAll(second).isEmpty()
    assert first.select(F.explode("x").alias("v")).where("v is null or isnan(v)").isEmpty()


def test_missing_input_columns_are_filled(spark, data):
    _, df = data
    lists = R.FeatureLists(("num", "other"), ("cat",), ("flag",))
    model, _ = R.fit_stages(R.preprocessing("logistic_regression", df, lists), df)
    out = model.transform(df.select(ID, "num"))
    assert out.select(vector_to_array(R.FEATURES).alias("x")).where(F.size("x") != 4).isEmpty()


def test_lists_route_and_deduplicate(data):
    lists = R.FeatureLists(("a", "b"), ("c", "a"), ("d",))
    assert lists.all() == ["a", "b", "c", "d"]
    assert lists.only(["a", "d"]) == R.FeatureLists(("a",), ("a",), ("d",))
