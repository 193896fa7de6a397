import pytest
from llm.helpers import awkward, none, shingle_set, similar, words

import corpus_pipeline


def run_stages(spark, docs, folder):
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], "").write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_each_stage_works_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    raw, good, single, cleaned, mixed, packed = run_stages(spark, docs, tmp_path)
    assert all(x.columns == docs.columns for x in (good, single, cleaned, mixed))
    texts = {r.doc_id: r.text for r in raw.collect()}
    good_ids, single_ids = {r.doc_id for r in good.collect()}, {r.doc_id for r in single.collect()}
    assert single_ids <= good_ids < set(texts)
    sets = {d: shingle_set(texts[d]) for d in good_ids}
    assert not any(similar(sets[a], sets[b]) for a in single_ids for b in single_ids if a < b)
    assert all(any(similar(sets[a], sets[b]) for b in good_ids - {a}) for a in good_ids - single_ids)
    kept = {r.doc_id: r.text for r in cleaned.collect()}
    assert set(kept) <= single_ids and all(set(words(t)) <= set(words(texts[d])) for d, t in kept.items())
    times = {}
    for r in mixed.collect():
        assert kept[r.doc_id] == r.text
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) == 2
    starts = [r.doc_id for r in packed.collect() if r.start == 0]
    assert sorted(starts) == sorted(d for d, n in times.items() for _ in range(n))


@pytest.mark.parametrize("make", [awkward, none])
def test_awkward_tables(spark, tmp_path, make):
    out = run_stages(spark, make(spark), tmp_path)
    assert (out[-1].count() > 0) == (make is awkward)


def test_run_is_the_stages(spark, tmp_path):
    assert len(corpus_pipeline.STAGES) == 5
    folder = "/root/testdata/sf0.001"
    stages = run_stages(spark, spark.read.parquet(f"{folder}/documents.parquet"), tmp_path)[-1]
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, stages.collect()))
