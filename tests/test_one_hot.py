"""One-hot vectors for any number of labels."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clientgrain.operators import one_hot as O
from clientgrain.operators import routing as R


def test_same_vectors_as_with_labels_on_the_driver(spark, tmp_path):
    train = spark.createDataFrame([("b", "x"), ("a", None), (None, "é"), ("a", "z"), ("0", 'q"\\')], "c string, d string")
    new = spark.createDataFrame([("a", "z"), ("new", None), (None, "é"), ("0", 'q"\\'), ("A", "x")], "c string, d string").coalesce(1)
    small, _ = R.fit_stages(R.one_hot_stages(["c", "d"]), train)
    wide, prepared = R.fit_stages(O.wide_one_hot_stages(["c", "d"]), train)
    assert prepared.columns == ["c", "d", "c_vec", "d_vec"]
    wide.write().overwrite().save(str(tmp_path / "model"))
    for model in (wide, PipelineModel.load(str(tmp_path / "model"))):
        one, two = (m.transform(new).select("c", "d", *[vector_to_array(f"{x}_vec").alias(x + "v") for x in "cd"]) for m in (small, model))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_an_empty_text_is_a_label(spark):
    """Which the indexer of ``one_hot_stages`` refuses."""
    train = spark.createDataFrame([("",), ("a",)], "c string")
    out = O.WideOneHot(inputCols=["c"], outputCols=["v"]).fit(train).transform(train)
    assert sorted((r.c, list(r.v.toArray())) for r in out.collect()) == [("", [1, 0]), ("a", [0, 1])]


def test_vectors_can_be_assembled(spark):
    from pyspark.ml.feature import VectorAssembler
    train = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "c string, x double")
    model, rows = R.fit_stages(O.wide_one_hot_stages(["c"]), train)
    out = VectorAssembler(inputCols=["c_vec", "x"], outputCol="f").transform(rows)
    assert sorted(list(r.f) for r in out.collect()) == [[0, 1, 1], [1, 0, 2]]


def test_no_rows(spark):
    none = spark.createDataFrame([], "c string")
    model, rows = R.fit_stages(O.wide_one_hot_stages(["c"]), none)
    assert rows.count() == 0
    out = model.transform(spark.createDataFrame([("a",), (None,)], "c string"))
    assert [len(r.c_vec) for r in out.collect()] == [0, 0]


def test_a_million_labels(spark, monkeypatch):
    """Slots are dense and in order, and no more rows reach the driver than there are columns."""
    n = 1_000_000
    train = spark.range(n).select(F.format_string("label %07d", F.col("id")).alias("c")).unionByName(spark.range(400_000).select(F.lit("hot").alias("c")))
    collected, honest = [], type(train).collect

    def counted(self):
        rows = honest(self)
        collected.append(len(rows))
        return rows
    monkeypatch.setattr(type(train), "collect", counted)
    model = O.WideOneHot(inputCols=["c"], outputCols=["v"]).fit(train)
    new = (spark.range(0, n + 5).select("id", F.format_string("label %07d", F.col("id")).alias("c"))
           .unionByName(spark.range(n + 5, n + 400_005).select("id", F.lit("hot").alias("c"))))
    out = model.transform(new)
    slot, size = O.slot_of("v")
    right = F.when(F.col("c") == "hot", 0).when(F.col("id") < n, F.col("id") + 1)
    row = out.select(F.count("*"), F.sum((~slot.eqNullSafe(right)).cast("int")), F.min(size), F.max(size)).first()
    assert tuple(row) == (n + 400_005, 0, n + 1, n + 1)
    assert max(collected, default=0) <= 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in honest(out.groupBy(F.spark_partition_id()).count())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 400_000


@pytest.mark.parametrize("limit", [1, 10_000])
def test_slots_by_slices(spark, limit):
    train = spark.range(3000).select(F.format_string("%05d", F.col("id") * 7).alias("c"))
    model = O.WideOneHot(inputCols=["c"], outputCols=["v"], single_pass_rows=limit).fit(train)
    assert [(r.label, r.slot) for r in model.slots.orderBy("slot").collect()] == [(f"{7 * i:05d}", i) for i in range(3000)]


def test_vectors_are_not_shuffled(spark):
    """They are made behind the joins, and of the counted keys only the frequent ones are stored."""
    from clientgrain.operators import lookup as L
    train = spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(50)], "c string, d string")
    model = O.WideOneHot(inputCols=["c", "d"], outputCols=["u", "v"]).fit(train)
    model._set(sizes={"c": [50, 10 ** 9], "d": [50, 10 ** 9]})      # too much text to broadcast
    out = model.transform(train)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan and plan.rindex("from_json") < plan.index("Join")
    assert out.columns == ["c", "d", "u", "v"]
    many = spark.range(3000).select(F.col("id").cast("string").alias("c")).unionByName(spark.range(500).select(F.lit("hot").alias("c")))
    kept = L._frequent(many, {"c": F.col("c")})
    assert kept.count() == 1 and kept.schema["_digest"].dataType.simpleString() == "binary"
