import itertools
import random

import pytest
from llm.helpers import DOCUMENTS, Groups, awkward, awkward_rows, none, shingle_set, similar

from clientgrain.llm import ngram_join
from clientgrain.llm.buckets import BLOCK, components


def brute(rows):
    sets = {(d, shingle_set(t)) for d, t in rows if d is not None}
    ids = sorted({d for d, _ in sets})
    groups, links = Groups(ids), dict.fromkeys(ids, 0)
    for (a, x), (b, y) in itertools.combinations(sorted(sets, key=lambda p: p[0]), 2):
        if a != b and similar(x, y):
            links[a] += 1
            links[b] += 1
            groups.join(a, b)
    return {d: (groups.top(d), links[d]) for d in ids}


def result(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect() if r.doc_id is not None}


def test_awkward_rows(spark):
    out = ngram_join.ngram_join(awkward(spark))
    assert result(out) == brute([(r[0], r[1]) for r in awkward_rows()])
    assert [(r.class_id, r.n_links) for r in out.where("doc_id IS NULL").collect()] == [(None, 0)]
    assert out.count() == 16


def test_empty(spark):
    assert ngram_join.ngram_join(none(spark)).collect() == []


def test_same_as_all_pairs(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert result(ngram_join.ngram_join(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_large_group_of_different_copies(spark):
    """More sets than a block holds, all alike: tiles must find every link once."""
    r = random.Random(3)
    base = [f"t{i}" for i in range(400)]
    rows = [(0, " ".join(base), "en", "a", 0)]
    for d in range(1, BLOCK * 2 + 40):
        w = list(base)
        for _ in range(r.randint(0, 16)):
            w[r.randrange(400)] = f"z{r.randrange(10**6)}"
        rows.append((d, " ".join(w), "en", "a", 0))
    assert result(ngram_join.ngram_join(spark.createDataFrame(rows, DOCUMENTS))) == brute([(x[0], x[1]) for x in rows])


def test_one_of_each(spark):
    kept = ngram_join.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    # 6 stands for its copies and for 15, which repeats it; each text without words for itself; the row without id stays.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, None, 5, 6, 9, 12, 13, 14, -3], key=str)


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(1, 2), (2, 1), (5, 5), (3, 4), (4, 2)], []])
def test_components(spark, edges):
    groups = Groups({x for e in edges for x in e})
    for a, b in edges:
        groups.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "id long, root long")).collect()}
    assert got == {x: groups.top(x) for e in edges if e[0] != e[1] for x in e}


def test_runs_follow_recall():
    assert ngram_join.runs_for(0.9) < ngram_join.runs_for(0.9999) <= 5
