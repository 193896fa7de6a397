import pytest
from llm.helpers import awkward, none
from tokenizers import Tokenizer

from clientgrain.llm import token_counts as TC
from clientgrain.llm.tokens import tokenizer_path

BYTES = "byte_bpe_50k.json"


def library_count(name):
    path = tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(sp.encode(text))
    t = Tokenizer.from_file(path)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", [BYTES, "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_as_the_library(spark, tmp_path, name):
    extra = spark.createDataFrame([(90, "a <|endoftext|> b<s> </s>  x", "en", "a", 1), (91, "  wide space \r\n", None, None, 2)], awkward(spark).schema.fieldNames()[:5])
    df = awkward(spark).unionByName(extra, allowMissingColumns=True)
    count = library_count(name)
    expected = sorted([(r.doc_id, len((r.text or "").encode()), n := count(r.text or ""), n > 512) for r in df.collect()], key=str)
    got = TC.token_counts(df, str(tmp_path / "cache"), tokenizer_path(name))
    assert sorted([tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()], key=str) == expected


def test_only_misses_are_encoded(spark, tmp_path, monkeypatch):
    cache, path = str(tmp_path / "cache"), tokenizer_path(BYTES)
    first = spark.createDataFrame([(1, "one"), (2, "two"), (3, "one"), (4, None), (5, "")], "doc_id long, text string")
    TC.token_counts(first, cache, path).collect()
    assert spark.read.parquet(cache).count() == 3
    added = []
    whole = TC.add_missing
    monkeypatch.setattr(TC, "add_missing", lambda texts, missing, n, *a: (added.append(n), whole(texts, missing, n, *a)))
    second = first.unionByName(spark.createDataFrame([(6, "six"), (7, "six"), (8, "two")], first.schema))
    rows = {r.doc_id: r.n_tokens for r in TC.token_counts(second, cache, path).collect()}
    assert added == [1] and spark.read.parquet(cache).count() == 4
    count = library_count(BYTES)
    assert rows == {1: count("one"), 2: count("two"), 3: count("one"), 4: 0, 5: 0, 6: count("six"), 7: count("six"), 8: count("two")}
    TC.token_counts(second, cache, path).collect()
    assert added == [1]


def test_stored_counts_are_what_comes_out(spark, tmp_path):
    # A wrong entry shows that a hit is not encoded again; one of another version is not a hit.
    cache, path = str(tmp_path / "cache"), tokenizer_path(BYTES)
    df = spark.createDataFrame([(1, "known"), (2, "other")], "doc_id long, text string")
    from pyspark.sql import functions as F
    entry = lambda text, n, version: df.limit(1).select(TC.digest_of(F.lit(text)).alias("digest"), F.lit(n).cast("long").alias("n_tokens"), F.lit(version).alias("tokenizer"))
    for rows in (entry("known", 777, TC.tokenizer_version(path)), entry("other", 888, "another")):
        rows.write.mode("append").partitionBy("tokenizer").parquet(cache)
    got = {r.doc_id: r.n_tokens for r in TC.token_counts(df, cache, path).collect()}
    assert got == {1: 777, 2: library_count(BYTES)("other")}


def test_many_misses_take_the_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TC, "fits_broadcast", lambda n: False)
    df = spark.createDataFrame([(i, f"text {i % 50} of many" if i % 3 else "hot") for i in range(600)], "doc_id long, text string")
    cache, count = str(tmp_path / "cache"), library_count(BYTES)
    got = {r.doc_id: r.n_tokens for r in TC.token_counts(df, cache, tokenizer_path(BYTES)).collect()}
    assert got == {r.doc_id: count(r.text) for r in df.collect()}
    assert spark.read.parquet(cache).count() == 51


def test_versions_differ_by_vocabulary():
    assert len({TC.tokenizer_version(tokenizer_path(n)) for n in (BYTES, "word_bpe_49k.json", "piece_bpe_32k.model")}) == 3


def test_empty_table(spark, tmp_path):
    assert TC.token_counts(none(spark), str(tmp_path / "cache"), tokenizer_path(BYTES)).collect() == []
