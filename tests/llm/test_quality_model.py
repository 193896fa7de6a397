from llm.helpers import DOCUMENTS, awkward, awkward_rows, none
from pyspark.sql import functions as F

from clientgrain.llm import quality_model as m

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    """Trained on half of the labels, right on nearly all of the others."""
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = m.quality_model(docs, labels.where(~held))
    right = out.join(labels.where(held), "doc_id").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right >= 0.95


def test_sparse_sites_are_shrunk(spark):
    """A host of poor documents pulls its documents down; a single poor document does not move its host."""
    rows = []
    for h in range(30):
        poor = h < 3
        rows += [(f"h{h}", "p", 0.1 if poor else 0.9) for _ in range(200)]
    rows += [("tiny", "p", 0.1)]
    scored = spark.createDataFrame(rows, "host string, path string, p_document double")
    hosts = {r.host: r for r in m.posteriors(scored).collect()}
    assert hosts["h0"].p_host < 0.2 and hosts["h9"].p_host > 0.85
    assert hosts["tiny"].p_host > 0.3


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(6, 1, 0), (14, 0, 0), (5, 1, 0), (2, 0, 0), (7, None, None), (None, 1, 0), (8, 7, 0)], LABELS)
    out = m.quality_model(awkward(spark), labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in awkward_rows())
    assert all(0 < r.p_quality < 1 and r.kept == (r.p_quality >= m.KEEP) for r in out)
    copies = [tuple(r) for r in out if r.doc_id == 6]
    assert len(copies) == 2 and copies[0] == copies[1]


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 1), (2, "d", "en", "s", 1)], DOCUMENTS)
    for rows, p in (([], 0.5), ([(1, 1, 0)], 1.0)):
        out = m.quality_model(docs, spark.createDataFrame(rows, LABELS)).collect()
        assert [r.p_document for r in out] == [p, p]


def test_empty(spark):
    assert m.quality_model(none(spark), spark.createDataFrame([], LABELS)).collect() == []
