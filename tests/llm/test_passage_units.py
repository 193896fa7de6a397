from collections import defaultdict

import numpy as np
from llm.helpers import DOCUMENTS, WORD, awkward, awkward_rows, none

from clientgrain.llm import passage_dedup, passage_units
from clientgrain.llm.texts import words_of

SIZE = passage_units.MIN_WORDS


def covered_words(rows):
    """For each (doc_id, text) the words of windows that stand elsewhere before, by a table of all windows."""
    texts = sorted({(d, t) for d, t in rows if d is not None and t})
    spots = [[m.span() for m in WORD.finditer(t)] for _, t in texts]
    seen = defaultdict(list)
    for k, (_, t) in enumerate(texts):
        words = [t[a:b] for a, b in spots[k]]
        for s in range(len(words) - SIZE + 1):
            seen[tuple(words[s:s + SIZE])].append((k, s))
    out = defaultdict(set)
    for places in seen.values():
        first = min(places)
        for k, s in places:
            if k != first[0] or s >= first[1] + SIZE:
                out[texts[k]] |= {spots[k][w] for w in range(s, s + SIZE)}
    return out


def found_words(docs):
    texts = defaultdict(set)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].add(r.text)
    out = defaultdict(set)
    spans = [r for r in passage_dedup.removals(docs).collect() if r.paragraph is None]
    for r in spans:
        for t in texts[r.doc_id]:
            if len(texts[r.doc_id]) == 1:
                inside = [m.span() for m in WORD.finditer(t) if r.start <= m.start() and m.end() <= r.end]
                assert len(inside) == r.n_words >= SIZE
                out[(r.doc_id, t)] |= set(inside)
    return out


def check(docs, rows, share):
    want, got = covered_words(rows), found_words(docs)
    assert set(got) <= set(want)
    # Nothing is removed that does not stand elsewhere, word by word.
    for k, own in got.items():
        assert own <= want[k]
    assert len(got) >= share * len(want)
    # Some words at the ends of passages stay, as EDGES has gaps.
    assert sum(map(len, got.values())) >= min(share, 0.9) * sum(map(len, want.values()))
    return want


def test_empty(spark):
    assert passage_dedup.removals(none(spark)).collect() == []


def test_awkward_rows(spark):
    assert check(awkward(spark), [(r[0], r[1]) for r in awkward_rows()], 0.9)


def test_given_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert check(docs, [(r.doc_id, r.text) for r in docs.collect()], 0.97)


def planted(n_words, n_docs, n_passages, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(4000)]

    def prose(n):
        return [vocabulary[i] for i in rng.integers(0, len(vocabulary), n)]
    passages = [prose(n_words) for _ in range(n_passages)]
    rows = []
    for d in range(n_docs):
        own = prose(int(rng.integers(60, 200)))
        at = int(rng.integers(0, len(own)))
        body = own[:at] + passages[d % n_passages] + own[at:]
        for _ in range(4):
            body[int(rng.integers(0, at))if at else 0] += "\n"
        rows.append((d, " ".join(body), "en", "a", 1))
    return rows


def test_passages_of_sixty_words_in_the_middle_of_lines(spark):
    rows = planted(60, 300, 60, 1)
    want = check(spark.createDataFrame(rows, DOCUMENTS), [(r[0], r[1]) for r in rows], 0.95)
    assert len(want) == 240


def test_passages_of_barely_fifty_words(spark):
    rows = planted(51, 300, 60, 2)
    check(spark.createDataFrame(rows, DOCUMENTS), [(r[0], r[1]) for r in rows], 0.9)


def test_shorter_passages_stay(spark):
    rows = planted(48, 100, 10, 3)
    assert passage_dedup.removals(spark.createDataFrame(rows, DOCUMENTS)).collect() == []


def test_parts_with_different_first_places(spark):
    """Half of a passage stands in an earlier document alone: the whole is found against the later one."""
    half, rest = (" ".join(f"{c}{i}" for i in range(35)) for c in "pq")
    other = [" ".join(f"x{d}y{i}" for i in range(40)) for d in range(6)]
    rows = [(0, f"{other[0]} {half} {other[1]}", "en", "a", 1), (1, f"{other[2]} {half} {rest} {other[3]}", "en", "a", 1),
            (2, f"{other[4]} {half} {rest} {other[5]}", "en", "a", 1)]
    spans = passage_dedup.removals(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert [(r.doc_id, r.first_doc_id, rows[2][1][r.start:r.end]) for r in spans] == [(2, 1, f"{half} {rest}")]


def test_passage_inside_lines_of_different_text_is_cut(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    other = [" ".join(f"x{d}y{i}" for i in range(90)) for d in range(6)]
    rows = [(d, f"start of {d}\n😀 {other[2 * d]} {passage} {other[2 * d + 1]}\nend of {d}", "en", "a", 1) for d in range(3)]
    out = {r.doc_id: r for r in passage_dedup.without_repeats(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert out[0].text == rows[0][1]
    for d in (1, 2):
        left = out[d].text
        assert left.startswith(f"start of {d}\n😀 {other[2 * d]}"[:200]) and left.endswith(f"{other[2 * d + 1]}\nend of {d}"[-200:])
        assert len(set(passage.split()) & set(left.split())) <= 20 and out[d].n_chars == len(left)


def test_repeats_in_one_document(spark):
    passage = " ".join(f"r{i}" for i in range(120))
    rows = [(1, "a " * 79, "en", "a", 1), (2, "b c d e f " * 60, "en", "a", 1), (3, f"{passage} between {passage}　😀", "en", "a", 1)]
    check(spark.createDataFrame(rows, DOCUMENTS), [(r[0], r[1]) for r in rows], 0.3)


def test_few_words_over_and_over(spark):
    """Runs of one to eight words that recur, whatever their hashes: all but what stands first is found."""
    rows = [(p, " ".join(f"o{p}v{i}" for i in range(60)) + " " + " ".join(f"r{p}v{i % p}" for i in range(400)), "en", "a", 1) for p in range(1, 9)]
    check(spark.createDataFrame(rows, DOCUMENTS), [(r[0], r[1]) for r in rows], 1)


def test_units_do_not_depend_on_what_stands_around():
    rng = np.random.default_rng(6)
    passage = [f"v{v}" for v in rng.integers(0, 900, 400)]
    found = []
    for before, sign in (("", " "), ("other words\nhere ", "\n"), ("é " * 33, " \t ")):
        text = before + sign.join(passage) + " and an end"
        data = text.encode()
        h, first, n, start, end = passage_units.units_of(data, passage_dedup.Paragraphs(text).h)
        assert all(WORD.findall(text[a:b]) == WORD.findall(text)[f:f + k] for f, k, a, b in zip(first, n, start, end))
        found.append(set(h.tolist()))
    assert len(found[0]) > 30 and found[0] <= found[1] | found[2] and len(found[1] & found[2]) >= len(found[0])


def test_run_hashes_tell_runs_apart():
    h = passage_dedup.Paragraphs("a b c a b c b a c a b").h
    assert [w.decode() for w in words_of("a b c a b c b a c a b")][:3] == ["a", "b", "c"]
    first = np.array([0, 3, 1, 6, 0, 9])
    out = passage_units.run_hashes(passage_units.mixed(h), first, first + np.array([3, 3, 3, 3, 2, 2]))
    assert out[0] == out[1] and out[4] == out[5] and len(set(out.tolist())) == 4
