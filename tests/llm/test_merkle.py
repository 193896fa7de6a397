import hashlib
import random
import zlib

from compare import compare, connect
from llm.helpers import DOCUMENTS, awkward, none

from clientgrain.llm import merkle
from clientgrain.llm.queries import QUERIES, SQL


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """The root and, for each node, (left siblings, right siblings) level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = level[i - i % 2:i - i % 2 + 2]
            path.append(("".join(run[:i % 2]), "".join(run[i % 2 + 1:])))
            i //= 2
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    subs = {}
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subs[lang] = (own, *tree([leaf(r) for r in own]))
    root, tops = tree([subs[lang][1] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        own, sub, paths = subs[lang]
        for r, path in zip(own, paths):
            chosen = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            now = leaf(r, 1 if chosen else 0)
            for before, behind in [*path, *top]:
                now = H(before, now, behind)
            proof = H(*[a + b for a, b in [*path, *top]])
            out.append((r["doc_id"], leaf(r), sub, root, proof, now, now == root))
    return sorted(out, key=str)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def result(df):
    return sorted([tuple(r[n] for n in NAMES) for r in merkle.tamper_check(df).collect()], key=str)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [r.asDict() for r in df.collect()]
    assert result(df) == brute(rows)


def test_several_tiers_and_uneven_ends(spark):
    # Groups of one, of a full block, one more, and of more than two tiers of small blocks.
    rng = random.Random(4)
    sizes = {"a": 1, "b": 256, "c": 257, None: 513, "é": 2, "zz": 900}
    rows = [(rng.randrange(10**6), f"text {i}", lang, rng.choice(["s", None]), rng.choice([None, 5, 2**63 - 1]))
            for lang, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    assert result(df) == brute([r.asDict() for r in df.collect()])


def test_small_blocks_give_the_same_tree(spark, monkeypatch):
    rows = [(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(100)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    assert result(df) == brute([r.asDict() for r in df.collect()])


def test_repeated_rows_fill_many_ranges(spark):
    rows = [(None, "same", None, None, None)] * 700 + [(3, "x", "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    assert result(df) == brute([r.asDict() for r in df.collect()])


def test_empty_table(spark):
    assert merkle.tamper_check(none(spark)).collect() == []


def test_other_columns_and_groups(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", 5)], "k long, body string, part int")
    rows = merkle.manifest(df, ["k", "body"], id_col="k", group="part").collect()
    assert {r["leaf"] for r in rows} == {H("1:1", "1:x"), H("1:2", "1:y")}
    assert {r["root"] for r in rows} == {H(H("1:1", "1:x"), H("1:2", "1:y"))}


def test_only_sql_functions(spark, tiny):
    plan = merkle.tamper_check(spark.read.parquet(f"{tiny}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_same_as_sql(spark, tiny):
    assert compare(QUERIES["op13_merkle_manifest"](spark, tiny), connect(tiny), SQL["op13_merkle_manifest"]) == []
