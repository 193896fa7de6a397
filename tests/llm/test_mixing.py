import duckdb
from compare import compare, connect
from llm.helpers import awkward, awkward_rows, none, words

from clientgrain.llm import mixing, queries


def test_same_as_sql(spark, tiny):
    assert compare(queries.QUERIES["op2_mix_sources"](spark, tiny), connect(tiny), mixing.MIX_SQL) == []


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    docs.select("doc_id", "text", "source").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    out = mixing.mix(docs)
    assert compare(out, con, mixing.MIX_SQL) == []
    rows = out.collect()
    assert len(rows) == len(awkward_rows()) and all(r.taken <= 2 * r["size"] for r in rows)
    assert sorted(r["size"] for r in rows) == sorted(len(words(r[1])) for r in awkward_rows())


def test_empty(spark):
    assert mixing.mix(none(spark)).collect() == []
    assert mixing.mixed_rows(none(spark)).collect() == []


def test_targets_stop_at_twice_the_source(spark):
    sources = spark.createDataFrame([("a", 10, 3.0), ("b", 1000, 1.0), ("c", 400, 2.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.with_targets(sources, 1.5, 2).collect()}
    assert got["a"] == 20 and abs(sum(got.values()) - 1.5 * 1410) < 1e-6 and abs(got["c"] - 800) < 1e-6


def test_larger_budgets_only_add(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    less = {r.doc_id: r.copies for r in mixing.mix(docs, share=0.8).collect()}
    more = {r.doc_id: r.copies for r in mixing.mix(docs, share=1.2).collect()}
    assert all(more[d] >= n for d, n in less.items()) and sum(more.values()) > sum(less.values())


def test_mixed_rows_come_as_often_as_taken(spark):
    docs = awkward(spark)
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    want = mixing.mix(docs).groupBy("doc_id").sum("copies").where("`sum(copies)` > 0").collect()
    got = rows.groupBy("doc_id").count().collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


def test_rows_without_id_are_taken_one_by_one(spark):
    rows = [(None if s == "a" else i, f"text {i} of ten words in all which are enough here", s) for s in "abc" for i in range(200)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 1, 1), share=0.8)
    taken = out.where("doc_id IS NULL").agg({"taken": "sum", "target": "max"}).first()
    assert abs(taken["sum(taken)"] - taken["max(target)"]) <= 10
