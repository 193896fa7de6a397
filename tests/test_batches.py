"""Accepted and rejected records of a stream."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientgrain.operators.lookup import attach
from clientgrain.streaming import batches
from clientgrain.streaming.scoring import application_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("amount", T.DoubleType(), False), T.StructField("note", T.StringType(), True)])


def incoming(spark, folder, files, first=0):
    """Files of 20 records; amounts are missing, no numbers, or good."""
    for f in range(first, first + files):
        rows = [(f * 20 + i, None if i % 5 == 0 else "many" if i % 7 == 0 else str(i), f"note {i}" if i % 2 else None) for i in range(20)]
        spark.createDataFrame(rows, "id long, amount string, note string").coalesce(1).write.mode("append").parquet(folder)
    return application_stream(spark, folder, T.StructType.fromDDL("id long, amount string, note string"), files_per_batch=1)


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize("sink", ["accepted", "rejected"])
def test_restart_in_the_middle(spark, tmp_path, monkeypatch, sink):
    """Whichever of the two writes breaks off, in the end each record is in one folder, once."""
    folder = str(tmp_path / "in")
    stream = incoming(spark, folder, 5)
    good, bad, progress = (str(tmp_path / n) for n in ("accepted", "rejected", "progress"))
    honest, broken = batches.write_batch, []

    def fails_once(rows, path):
        honest(rows, path)
        if f"/{sink}/" in path and path.endswith("batch-2") and not broken:
            broken.append(path)
            raise RuntimeError("the driver is lost")

    monkeypatch.setattr(batches, "write_batch", fails_once)
    with pytest.raises(Exception, match="the driver is lost"):
        batches.split_stream(stream, good, bad, progress, SCHEMA)
    accepted, rejected = batches.split_stream(stream, good, bad, progress, SCHEMA)
    assert broken and ids(accepted.select("id").union(rejected.select("id"))) == list(range(100))
    wrong = {f * 20 + i for f in range(5) for i in range(20) if i % 5 == 0 or i % 7 == 0}
    assert set(ids(rejected)) == wrong and rejected.where("problems != array('amount')").isEmpty()
    assert accepted.schema["amount"].dataType == T.DoubleType() and accepted.where("amount IS NULL").isEmpty()
    # Later files are added, and nothing is read twice.
    accepted, rejected = batches.split_stream(incoming(spark, folder, 2, 5), good, bad, progress, SCHEMA)
    assert ids(accepted.select("id").union(rejected.select("id"))) == list(range(140))


def test_a_new_checkpoint_replaces_nothing(spark, tmp_path):
    stream = incoming(spark, str(tmp_path / "in"), 2)
    good, bad = str(tmp_path / "accepted"), str(tmp_path / "rejected")
    for i in range(2):
        accepted, rejected = batches.split_stream(stream, good, bad, str(tmp_path / f"progress{i}"), SCHEMA)
    assert accepted.count() + rejected.count() == 80


def test_an_empty_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = application_stream(spark, str(tmp_path / "in"), T.StructType.fromDDL("id long, amount string, note string"))
    accepted, rejected = batches.split_stream(stream, *[str(tmp_path / n) for n in ("accepted", "rejected", "progress")], SCHEMA)
    assert accepted.columns == ["id", "amount", "note"] and rejected.columns == ["id", "amount", "note", "problems"]
    assert accepted.isEmpty() and rejected.isEmpty()


def test_hot_unseen_key_of_a_batch_is_spread(spark, tmp_path):
    """Keys that are frequent in a batch are found before its join, so no partition holds all of an unknown one."""
    facts = spark.createDataFrame([(f"k{i}", i) for i in range(300)], "c string, i long").unionByName(
        spark.range(300, 4300).select(F.lit("new").alias("c"), F.col("id").alias("i")))
    facts.coalesce(1).write.parquet(str(tmp_path / "in"))
    table = spark.createDataFrame([(f"k{i}", float(i), 1) for i in range(300)], "category string, mean double, n long")

    def encoded(rows):
        return attach(rows, {"category": F.col("c")}, table, "mean", "m", rows=300, text=1_000, limit=100).withColumn("partition", F.spark_partition_id())

    schema = T.StructType([T.StructField("c", T.StringType(), False), T.StructField("i", T.LongType(), False)])
    stream = application_stream(spark, str(tmp_path / "in"), facts.schema)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out, _ = batches.split_stream(stream, *[str(tmp_path / n) for n in ("accepted", "rejected", "progress")], schema, encoded)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert out.count() == 4300 and out.where("c = 'new' AND m IS NOT NULL OR c != 'new' AND m != i OR c != 'new' AND m IS NULL").isEmpty()
    assert out.groupBy("partition").count().agg(F.max("count")).first()[0] < 3000
