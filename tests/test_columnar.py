"""Statistics of array positions by batches, against numpy and Spark's own functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientgrain.operators import columnar as C
from clientgrain.operators import encoders as E
from clientgrain.operators import metrics as M
from clientgrain.operators import packed as P


@pytest.fixture(scope="module")
def columns():
    r = np.random.default_rng(8)
    n = 3000
    made = [r.normal(0, 1, n), r.lognormal(0, 3, n), np.round(r.normal(0, 2, n)), np.full(n, 5.0), np.where(r.random(n) < 0.5, -0.0, 0.0), r.normal(0, 1e-300, n),
            np.where(r.random(n) < 0.01, np.inf, -r.exponential(1, n))]
    known = [r.random(n) < 0.8 for _ in made]
    return [x[k] for x, k in zip(made, known)], made, known


@pytest.fixture(scope="module")
def arrays(spark, columns):
    _, made, known = columns
    rows = [([float(x[i]) if k[i] else None for x, k in zip(made, known)] + [None],) for i in range(len(made[0]))]
    return spark.createDataFrame(rows, "x array<double>").repartition(5)


def test_quantiles_are_exact(arrays, columns):
    values, *_ = columns
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = C.array_quantiles(arrays, len(values) + 1, probs)
    for x, found in zip(values, got):
        whole = np.sort(x)
        for p, v in zip(probs, found):
            place = p * (len(x) - 1)
            low, high = whole[int(np.floor(place))], whole[int(np.ceil(place))]
            assert v == (low if place == np.floor(place) else (np.ceil(place) - place) * low + (place - np.floor(place)) * high)
    assert got[-1] == [None] * 5


def test_not_a_number_is_above_all_others(spark):
    df = spark.createDataFrame([([float("nan")],), ([1.0],), ([2.0],), ([float("inf")],), ([-1.0],)], "x array<double>").repartition(2)
    low, middle, high = C.array_quantiles(df, 1, [0.0, 0.5, 1.0])[0]
    assert (low, middle) == (-1.0, 2.0) and np.isnan(high)


def test_moments_and_constants_and_powers(arrays, columns):
    values, *_ = columns
    n = len(values) + 1
    finite = [i for i, x in enumerate(values) if np.isfinite(x).all()]
    found = C.moments(arrays, n, lambda slot, x: np.stack([x, x + 1e9]))
    for i in finite:
        assert found[i, 0] == pytest.approx((values[i].mean(), values[i].var()), rel=1e-9, abs=1e-12)
        if i < 3:
            assert found[i, 1][1] == pytest.approx(values[i].var(), rel=1e-5)
    long = P.long_rows(arrays)
    before, now = E._constants(long), C.constants(arrays, n)
    assert before.keys() == now.keys() and all(now[c] == pytest.approx(before[c], rel=1e-9) for c in before)
    clean = arrays.select(F.array(F.col("x")[0], F.col("x")[1], F.col("x")[2]).alias("x"))
    expected, got = E.fit_long_powers(P.long_rows(clean)), E.fit_array_powers(clean, 3)
    assert got == pytest.approx(expected, abs=1e-6)


def test_scaling_runs_by_batches(spark, columns):
    """No function is called for each entry of a row, neither when learning nor when applying."""
    r = np.random.default_rng(2)
    df = spark.createDataFrame([(float(a), None if a > 1 else float(a) ** 2) for a in r.normal(0, 1, 300)], "a double, b double")
    out = P.PackedScaling(inputCols=["a", "b"], outputCol="x").fit(df).transform(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambda" not in plan
    of = {"median": [0.0, 0.5], "power": [0.3, 1.7], "mean": [0.1, 0.2], "deviation": [2.0, 3.0], "center": [0.0, 0.1], "scale": [1.0, 0.5]}
    got = P.PackedScalingModel(inputCols=["a", "b"], outputCol="x", learned=of).transform(df.withColumns({"c": F.col("a"), "d": F.col("b")}))
    straight = [((E.yeo_johnson(F.coalesce(c, F.lit(of["median"][i])), of["power"][i]) - of["mean"][i]) / of["deviation"][i] - of["center"][i]) / of["scale"][i]
                for i, c in enumerate((F.col("c"), F.col("d")))]
    assert got.where((F.abs(F.col("x")[0] - straight[0]) > 1e-12) | (F.abs(F.col("x")[1] - straight[1]) > 1e-12)).isEmpty()


def test_no_rows(spark):
    none = spark.createDataFrame([], "a double")
    model = P.PackedScaling(inputCols=["a"], outputCol="x").fit(none)
    assert model.transform(none).count() == 0
    assert model.getOrDefault(model.learned)["median"] == [0.0]


@pytest.mark.parametrize("edges", [{}, {0: [0.0], 2: [-1.0, -0.0, 1.5]}])
def test_areas_of_moved_margins(spark, edges):
    """Packed margins against the area of rows: ties, nulls, not-a-numbers and a repeat with one class only."""
    r = np.random.default_rng(3)
    rows = []
    for i in range(900):
        own, other = (np.round(r.normal(0, 2, 3)).tolist() for _ in range(2))
        if i % 50 == 0:
            own[2] = None
        if i % 70 == 0:
            other[2] = float("nan")
        rows.append((i % 3, int(r.random() < 0.3) if i % 3 < 2 else 1, None if i % 90 == 0 else float(np.round(r.normal())), own, other))
    df = spark.createDataFrame(rows, "_repeat int, y int, _margin double, x array<double>, donor array<double>").repartition(4)
    weights = [0.5, 0.0, -1.0]
    codes = C.ordering()
    cells = {s: sorted({int(codes(np.array([v]))[0]) for v in values}) for s, values in edges.items()}
    found = {(a["_repeat"], a["_slot"]): a["roc_auc"] for a in C.moved_areas(df, "y", weights, [0, 2], cells).collect()}
    for slot in (0, 2):
        score = F.col("_margin") + (F.col("donor")[slot] - F.col("x")[slot]) * F.lit(weights[slot])
        for a in M.roc_auc(df.withColumn("s", score), "y", "s", ["_repeat"]).collect():
            assert found.pop((a["_repeat"], slot)) == a["roc_auc"]
    assert not found
