import itertools
from collections import defaultdict

import numpy as np
from llm.helpers import DOCUMENTS, Groups, awkward, awkward_rows, none, shingle_set, similar, words

from clientgrain.llm import passage_dedup
from clientgrain.llm.buckets import shingles
from clientgrain.llm.texts import words_of


def brute(rows):
    paragraphs = []
    for d, text in sorted({(d, t) for d, t in rows if d is not None and t}):
        at = place = 0
        for number, line in enumerate(text.split("\n")):
            if words(line):
                paragraphs.append((d, number, place, at, at + len(line), len(words(line)), shingle_set(line)))
                place += 1
            at += len(line) + 1
    sets = list({p[6] for p in paragraphs})
    groups = Groups(range(len(sets)))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if similar(sets[i], sets[j]):
            groups.join(i, j)
    cluster = {s: groups.top(i) for i, s in enumerate(sets)}
    first = {}
    for p in paragraphs:
        k = cluster[p[6]]
        first[k] = min(first.get(k, p[:2]), p[:2])
    again = defaultdict(list)
    for p in paragraphs:
        if first[cluster[p[6]]] != p[:2]:
            again[p[0]].append(p)
    out = set()
    for found in again.values():
        found.sort(key=lambda p: p[2])
        for _, run in itertools.groupby(enumerate(found), key=lambda x: x[1][2] - x[0]):
            run = [p for _, p in run]
            if sum(p[5] for p in run) >= passage_dedup.MIN_WORDS:
                out |= {(p[0], p[1], p[3], p[4], p[5], *first[cluster[p[6]]]) for p in run}
    return out


def test_awkward_rows(spark):
    got = [tuple(r) for r in passage_dedup.repeated_paragraphs(awkward(spark)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute([(r[0], r[1]) for r in awkward_rows()])


def test_empty(spark):
    assert passage_dedup.repeated_paragraphs(none(spark)).collect() == []


def test_same_as_all_pairs(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert {tuple(r) for r in passage_dedup.repeated_paragraphs(docs).collect()} == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_passages_go_and_short_lines_stay(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    changed = passage.replace("p30 ", "other ")
    halves = "\n".join([" ".join(f"q{i}" for i in range(28)), " ".join(f"q{i}" for i in range(28, 56))])
    rows = [(i, f"own {i} {i * 31} words here\ncommon line of a site\n{body}\nend {i} of {i * 17}", "en", "a", 1)
            for i, body in enumerate([passage, changed, "clean words only", halves, halves, "common line of a site"])]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    out = {r.doc_id: r.text for r in passage_dedup.without_repeats(docs).collect()}
    assert out[0] == rows[0][1] and out[2] == rows[2][1] and out[3] == rows[3][1] and out[5] == rows[5][1]
    assert "p29" not in out[1] and "own 1" in out[1] and "end 1" in out[1]
    assert "q3 " not in out[4] and "q55" not in out[4] and "own 4" in out[4]


def test_without_repeats_on_awkward_rows(spark):
    docs = awkward(spark)
    out = passage_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} >= {5, 6, 9, 12, 13, None} and not {r.doc_id for r in rows} & {1, 2, 3, 7}
    assert all(r.n_chars == len(r.text) for r in rows)


def test_paragraph_sets_are_the_plain_ones():
    text = "\n".join(["a b c d e f g a b c d e f g", "", "a b", "one", "x y z w v u"])
    got = passage_dedup.Paragraphs(text).sets()
    want = [shingles(words_of(line)) for line in text.split("\n") if line]
    assert [len(g) for _, g in got] == [len(w) for w in want]
    assert all(np.array_equal(g, w) for (_, g), w in zip(got, want))


def test_bands_reach_the_recall():
    b = passage_dedup.bands_for()
    assert 1 - (1 - 0.8 ** passage_dedup.ROWS) ** b >= passage_dedup.RECALL
