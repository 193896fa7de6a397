import re
from collections import Counter, defaultdict

import math
from llm.helpers import DOCUMENTS, awkward, awkward_rows, none, words

from clientgrain.llm import quality_rules as q


def plain_counts(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), sum(x in lines[:i] for i, x in enumerate(lines)),
            len({i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}))


def plain_verdicts(rows):
    """The rule by its definition: nearest-rank quartiles of cells, each level's drawn towards the one above."""
    counts = [plain_counts(r[1]) for r in rows]
    values = []
    for n, chars, symbols, lines, dup, rep in counts:
        values.append((symbols / max(n, 1), dup / max(lines, 1), rep / max(n, 1), chars / max(n, 1)))
    failed = [c[0] < 50 or 100 * c[5] > 50 * c[0] for c in counts]
    groups = defaultdict(list)
    for r, v, f in zip(rows, values, failed):
        if not f:
            for k in ((r[2], r[3]), (r[2],), ()):
                groups[k].append(v)

    def quartiles(key, i):
        cells = sorted(math.floor(math.log1p(v[i] * 1000) / math.log(q.GROWTH)) for v in groups[key])
        own = [math.expm1((cells[math.ceil(len(cells) * p) - 1] + 0.5) * math.log(q.GROWTH)) / 1000 for p in (0.25, 0.75)]
        if not key:
            return own
        n = len(cells)
        return [(n * a + q.WEIGHT * b) / (n + q.WEIGHT) for a, b in zip(own, quartiles(key[:-1], i))]

    def fence(key, i):
        low, high = quartiles(key, i)
        wide = q.REACH * max(high - low, q.MEASURES[i].least_spread)
        return (low - wide if q.MEASURES[i].both else -math.inf), high + wide

    out = []
    for r, v, f, c in zip(rows, values, failed, counts):
        out.append((r[0], *c[:3], c[4], c[5], f, not f and all(a <= x <= b for x, (a, b) in zip(v, (fence((r[2], r[3]), i) for i in range(4))))))
    return out


def key(row):
    return tuple(str(x) for x in row)


def test_awkward_rows(spark):
    got = [tuple(r) for r in q.quality_rules(awkward(spark)).collect()]
    assert sorted(got, key=key) == sorted(plain_verdicts(awkward_rows()), key=key)


def test_same_as_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    got = [tuple(r) for r in q.quality_rules(docs).collect()]
    assert sorted(got) == sorted(plain_verdicts(rows))
    assert sorted(r.doc_id for r in q.kept_rows(docs).collect()) == sorted(r[0] for r in got if r[7])


def test_junk_goes_and_prose_stays(spark):
    import random
    r = random.Random(1)

    def prose():
        return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(r.randint(60, 300)))
    rows = [(i, prose(), "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, prose().replace(" ", " | "), "en", "s", 1) for i in range(60)]
    rows += [(2000 + i, "\n".join([prose()[:200]] * 8 + [prose()]), "en", "s", 1) for i in range(5)]
    got = {x.doc_id: x.kept for x in q.quality_rules(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert all(got[d] == (d < 1000) for d in got)


def test_a_small_group_has_a_say(spark, monkeypatch):
    """Texts that are usual in their small source and odd elsewhere: the weight decides, not a least size."""
    rows = [(i, " ".join(f"{'abcdef'[:3 + (i + k) % 4]}{k}" for k in range(80)), "en", "wide", 1) for i in range(300)]
    rows += [(1000 + i, " ".join(f"abcdefghijklmnop{k:03d}" for k in range(80)) + f" {i}", "en", "narrow", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    for weight, kept in ((1, True), (10**9, False)):
        monkeypatch.setattr(q, "WEIGHT", weight)
        verdicts = {r.doc_id: r.kept for r in q.quality_rules(docs).collect()}
        assert all(verdicts[1000 + i] == kept for i in range(60)) and all(verdicts[i] for i in range(300))


def test_empty(spark):
    assert q.quality_rules(none(spark)).collect() == []
    assert q.kept_rows(none(spark)).collect() == []


def test_kept_rows_are_unchanged(spark):
    docs = awkward(spark)
    out = q.kept_rows(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}


def test_sketches_merge(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    measured = q.measure(docs, ["doc_id", "lang", "source"])
    whole = q.sketches(measured, "lang", "source")
    parts = q.sketches(measured.where("doc_id % 2 = 0"), "lang", "source").unionByName(q.sketches(measured.where("doc_id % 2 = 1"), "lang", "source"))
    assert sorted(map(str, q.quartiles(whole, ["lang"]).collect())) == sorted(map(str, q.quartiles(parts, ["lang"]).collect()))
