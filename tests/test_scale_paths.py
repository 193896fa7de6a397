"""The paths taken at scale give the same answers as the simple ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientgrain.operators import history as H
from clientgrain.operators import metrics as MT
from clientgrain.operators.lookup import attach
from clientgrain.operators.quantiles import exact_quantiles
from clientgrain.operators.running import running_totals


def skewed(rows=3000, seed=3):
    """A third of the rows in one group, many repeated values, some nulls."""
    r = np.random.default_rng(seed)
    keys = np.where(r.random(rows) < 0.34, 0, r.integers(1, 40, rows))
    values = np.where(r.random(rows) < 0.3, 7.0, np.round(r.normal(0, 100, rows), 3))
    return [(int(k), None if r.random() < 0.05 else float(v)) for k, v in zip(keys, values)]


@pytest.mark.parametrize("single_pass", [10, 10_000])
def test_running_totals(spark, single_pass):
    rows = [(g, i, (i * 7) % 11) for g in (1, 2) for i in range(500)] + [(2, None, 5)]
    df = spark.createDataFrame(rows, "g int, o int, m long")
    out = running_totals(df, ["g"], ["o"], ["m"], single_pass_rows=single_pass).collect()
    expected, acc = {}, {1: 0, 2: 0}
    for g, o, m in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        expected[g, o] = acc[g]
        acc[g] += m
    assert {(r.g, r.o): r.m_before for r in out} == expected


@pytest.mark.parametrize("options", [{}, {"group_rows": 100}, {"group_rows": 100, "single_pass_rows": 5},
                                     {"group_rows": 100, "accuracy": 20}])
def test_quantiles_of_a_column(spark, options):
    data = skewed()
    df = spark.createDataFrame(data, "k int, v double").withColumn("w", F.col("v") * 2).withColumn("empty", F.lit(None).cast("double"))
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    out = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["v", "w", "empty"], probs, **options).collect()}
    known = np.array([v for _, v in data if v is not None])
    for p in probs:
        assert out["v", p] == pytest.approx(np.quantile(known, p), rel=1e-12)
        assert out["w", p] == pytest.approx(np.quantile(known * 2, p), rel=1e-12)
        assert out["empty", p] is None


def test_quantiles_survive_a_bad_sketch(spark, monkeypatch):
    """Brackets that miss the rank are searched again without bounds."""
    from clientgrain.operators import quantiles as Q
    data = skewed()
    df = spark.createDataFrame(data, "k int, v double")
    honest = Q._brackets
    monkeypatch.setattr(Q, "_brackets", lambda *a: honest(*a).withColumns({"low": F.lit(6.9), "high": F.lit(7.0)}))
    out = {r["prob"]: r["value"] for r in Q.exact_quantiles(df, ["v"], [0.1, 0.9], group_rows=100).collect()}
    known = np.array([v for _, v in data if v is not None])
    assert out == {p: pytest.approx(np.quantile(known, p), rel=1e-12) for p in (0.1, 0.9)}


def test_hot_client_gets_the_same_statistics(spark):
    rows = [(k, i, v, None if v is None else v / 3) for i, (k, v) in enumerate(skewed())]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_BUREAU long, a double, b double")
    plain = {r["SK_ID_CURR"]: r.asDict() for r in H.bureau_aggregate(df).collect()}
    for limit in (200, 50, 10):
        hot = {r["SK_ID_CURR"]: r.asDict() for r in H.bureau_aggregate(df, group_rows=limit).collect()}
        assert hot.keys() == plain.keys()
        for k in plain:
            assert hot[k] == pytest.approx(plain[k], rel=1e-12, nan_ok=True)


def test_large_lookup_with_a_heavy_key(spark):
    facts = spark.createDataFrame([("hot",)] * 400 + [(f"k{i}",) for i in range(200)] + [("unseen",), (None,)], "c string")
    table = spark.createDataFrame([("hot", 0.5, 400_000)] + [(f"k{i}", float(i), 1) for i in range(200)], "category string, mean double, n long")
    small = attach(facts, {"category": F.col("c")}, table, "mean", "m", rows=201, text=900)
    large = attach(facts, {"category": F.col("c")}, table, "mean", "m", rows=201, text=900, limit=100)
    long_text = attach(facts, {"category": F.col("c")}, table, "mean", "m", rows=201, text=10**9)
    assert sorted(map(str, small.collect())) == sorted(map(str, long_text.collect()))
    assert small.columns == large.columns == ["c", "m"]
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert large.where("m is null").count() == 2 and large.count() == 602


def test_auc_is_the_share_of_ordered_pairs(spark):
    r = np.random.default_rng(1)
    y = r.integers(0, 2, 400)
    s = np.round(r.random(400) + 0.2 * y, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    expected = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    for limit in (10, 10_000):
        assert MT.roc_auc(df, "y", "s", single_pass_rows=limit).first()[0] == pytest.approx(expected, rel=1e-12)
    assert MT.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = MT.class_metrics(df, "y", "p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)
    assert sorted(tuple(r) for r in MT.confusion_matrix(df, "y", "p").collect()) == [(0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0)]


def test_confusion_and_report_by_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), (None, 0, 0)], "g string, y int, p int")
    cells = {(r.g, r.actual, r.predicted): r.n for r in MT.confusion_matrix(df, "y", "p", ["g"]).collect()}
    assert len(cells) == 8 and cells["a", 1, 1] == cells["a", 0, 1] == cells[None, 0, 0] == 1
    assert MT.class_report(df, "y", "p", ["g"]).count() == 10


def test_ties_between_models_go_by_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1), ("d", None)], "model string, test_roc_auc double")
    assert tuple(MT.best_model(df).first()) == ("a", 0.9)


@pytest.mark.parametrize("options", [{}, {"single_pass_rows": 5}])
def test_a_null_group_is_a_group(spark, options):
    rows = [(None if i % 3 else "a", i % 2, float(i * 7 % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.g: r.roc_auc for r in MT.roc_auc(df, "y", "s", ["g"], **options).collect()}
    for g in ("a", None):
        pos, neg = ([s for k, y, s in rows if k == g and y == label] for label in (1, 0))
        assert got[g] == pytest.approx(np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]))
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["s"], [0.25, 0.5], ["g"], **options).collect()}
    for g in ("a", None):
        assert [got[g, p] for p in (0.25, 0.5)] == pytest.approx(np.quantile([s for k, _, s in rows if k == g], [0.25, 0.5]))


def test_hot_unseen_value_is_spread(spark):
    """A value that is frequent in the rows at hand and unknown to the table fills no partition of its own."""
    facts = spark.createDataFrame([("new",)] * 4000 + [(f"k{i}",) for i in range(300)], "c string").selectExpr("c", "monotonically_increasing_id() AS i")
    table = spark.createDataFrame([(f"k{i}", float(i), 1) for i in range(300)], "category string, mean double, n long")
    long_key = spark.createDataFrame([("x" * 50_000, 7.0, 10_000)], table.schema)
    facts = facts.unionByName(spark.createDataFrame([("x" * 50_000, -1)], "c string, i long"))
    out = attach(facts, {"category": F.col("c")}, table.unionByName(long_key), "mean", "m", rows=301, text=2_000, limit=100)
    got = {r.i: r.m for r in out.where("c != 'new'").collect()}
    assert out.where("c = 'new'").count() == 4000 and out.where("c = 'new' AND m IS NOT NULL").isEmpty()
    assert len(got) == 301 and got[-1] == 7.0 and None not in got.values()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 3000


def test_groups_of_all_sizes_have_exact_quantiles(spark):
    """Small groups are counted by value, large ones bracketed; unknown columns and null groups keep their rows."""
    data = [*skewed(), *[(None, float(i % 17)) for i in range(50)], *[(-1, None)] * 5]
    df = spark.createDataFrame(data, "k int, v double").withColumn("w", -F.col("v"))
    probs = [0.0, 0.25, 0.75, 1.0]
    plain = exact_quantiles(df, ["v", "w"], probs, ["k"]).collect()
    assert sorted(map(str, plain)) == sorted(map(str, exact_quantiles(df, ["v", "w"], probs, ["k"], group_rows=60).collect()))
    got = {(r.k, r["column"], r.prob): (r.n, r.value) for r in plain}
    assert len(got) == len(plain) == len({k for k, _ in data}) * 2 * len(probs)
    for k in {k for k, _ in data}:
        known = [v for g, v in data if g == k and v is not None]
        for p in probs:
            for c, sign in (("v", 1), ("w", -1)):
                expected = pytest.approx(np.quantile(np.array(known) * sign, p), rel=1e-12) if known else None
                assert got[k, c, p] == (len(known), expected)


def test_hot_clients_are_read_once(spark, tmp_path):
    """However many passes their quartiles take, the history joined before is computed for one of them."""
    rows = [(k, i, v) for i, (k, v) in enumerate(skewed())]
    spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_BUREAU long, a double").write.parquet(f"{tmp_path}/bureau")
    stored = spark.read.parquet(f"{tmp_path}/bureau")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    out = H.wide_aggregate(stored.mapInArrow(counted, stored.schema), "SK_ID_CURR", "SK_ID_BUREAU", ("MEAN", "_Q25", "_Q75"), "B", "N",
                           key_rows=stored, group_rows=10)
    assert out.count() == len({k for k, _, _ in rows})
    assert read.value == len(rows)


def test_quartiles_shuffle_rows_and_not_what_was_gathered(spark):
    """The rows of a client meet before anything is gathered for its quartiles; without quartiles means combine before the shuffle."""
    rows = [(None if i % 50 == 0 else k, i, v) for i, (k, v) in enumerate(skewed())]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, SK_ID_BUREAU long, a double").repartition(7)
    out = H.wide_aggregate(df, "SK_ID_CURR", "SK_ID_BUREAU", ("MEAN", "_Q25", "_Q75"), "B", "N")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile" not in plan[plan.index("Exchange hashpartitioning(SK_ID_CURR"):]
    means = H.wide_aggregate(df, "SK_ID_CURR", "SK_ID_BUREAU", ("MEAN",), "B", "N")
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan[plan.index("Exchange hashpartitioning(SK_ID_CURR"):]
    got = {r["SK_ID_CURR"]: r for r in out.collect()}
    assert got.keys() == {k for k, _, _ in rows if k is not None}
    for k, r in got.items():
        of = [v for g, _, v in rows if g == k]
        known = np.array([v for v in of if v is not None])
        assert (r["N"], r["B_a__Q25"], r["B_a__Q75"]) == (len(of), *[pytest.approx(np.quantile(known, p), rel=1e-12) for p in (0.25, 0.75)])
        assert r["B_a_MEAN"] == pytest.approx(known.mean(), rel=1e-12)
