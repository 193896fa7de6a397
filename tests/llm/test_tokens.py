"""Packing and token records against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm.helpers import awkward, awkward_rows, none
from tokenizers import Tokenizer

from clientgrain.llm import packing, token_files
from clientgrain.llm.tokens import Words, tokenizer_path
from clientgrain.session import scratch_path

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def ids_of(path, text, end):
    return np.array([*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_word_by_word_is_the_whole_text(path):
    r, whole, mine = random.Random(2), Tokenizer.from_file(path), Words(path)
    bits = [" ", "  ", "\n", " \n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", chr(0x2003), chr(0x3000), "a", "The", "word,", "end.", "don't", "'s",
            "1", "23", "é", "É", "é", "ß", "İ", "ΑΣ", "中文", "😀", "<|endoftext|>", "<|startoftext|>", "", "x" * 90, "...", "a.b", "\x00"]
    for _ in range(1500):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 25)))
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def packed(spark, docs):
    rows = packing.pack(docs, WORDS).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for p in sorted(pieces, key=lambda p: (p.offset, p.length)):
            assert p.offset == at
            at += p.length
        assert at <= packing.LENGTH
    return rows, by


def test_pack_awkward_rows(spark):
    rows, _ = packed(spark, awkward(spark))
    whole = sorted((str(d), len(i)) for d, i in ((r[0], ids_of(WORDS, r[1], 1)) for r in awkward_rows()))
    of = {(r[0], r[1]): ids_of(WORDS, r[1], 1) for r in awkward_rows()}
    got = defaultdict(int)
    for r in rows:
        ids = next(i for (d, _), i in of.items() if d == r.doc_id)
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length])
        got[r.doc_id] += r.length
    assert sum(got.values()) == sum(n for _, n in whole)
    starts = sorted((r.start, r.length) for r in rows if r.doc_id == 5)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and sum(starts[-1]) == len(ids_of(WORDS, awkward_rows()[4][1], 1))


def test_pack_wastes_little(spark, tiny):
    rows, by = packed(spark, spark.read.parquet(f"{tiny}/documents.parquet"))
    assert sum(r.length for r in rows) >= 0.95 * packing.LENGTH * len(by)


def test_pack_empty(spark):
    assert packing.pack(none(spark), WORDS).collect() == []


def test_patterns_hold_the_demand():
    rng = np.random.default_rng(1)
    for n in (0, 1, 30, 3000):
        demand = np.bincount(rng.integers(1, 128, n), minlength=128)
        sizes = [i for i in range(1, 128) if demand[i]]
        plan = packing.rounded_patterns(sizes, [int(demand[i]) for i in sizes], 128)
        held = defaultdict(int)
        for pattern, times in plan:
            assert sum(s * k for s, k in pattern.items()) <= 128 and times > 0
            for s, k in pattern.items():
                held[s] += k * times
        assert dict(held) == {s: int(demand[s]) for s in sizes}
        least = -(-sum(s * int(demand[s]) for s in sizes) // 128)
        assert sum(t for _, t in plan) <= least * 1.02 + 2


def test_records_round_trip(spark):
    folder = scratch_path(spark, "records")
    index = token_files.write_records(awkward(spark), folder, BYTES, files=3)
    got = sorted(((r.start, r.n_tokens, r.ids_crc32) for r in token_files.encoded_documents(index, folder).collect()))
    rows = sorted(awkward_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, at = [], 0
    for r in rows:
        ids = ids_of(BYTES, r[1], 0)
        want.append((at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert got == want
    # Any part of the index, in any order, reads its own records.
    some = index.where("number % 2 = 1").orderBy("length")
    assert token_files.read_records(some, folder).count() == some.count()


def test_no_records(spark):
    folder = scratch_path(spark, "records")
    assert token_files.encoded_documents(token_files.write_records(none(spark), folder, BYTES, files=2), folder).collect() == []


def test_damage_is_seen():
    whole = token_files.frame(b"some ids")
    assert bytes(token_files.unframe(memoryview(whole))[0]) == b"some ids"
    for i in range(len(whole)):
        broken = bytearray(whole)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            token_files.unframe(memoryview(bytes(broken)))
    with pytest.raises(ValueError):
        token_files.unframe(memoryview(whole[:-1]))


def test_ids_that_do_not_fit_fail(spark):
    docs = awkward(spark).where("doc_id = 9")
    with pytest.raises(Exception, match="token id 70000 does not fit 2 bytes"):
        token_files.write_records(docs, scratch_path(spark, "records"), BYTES, end_id=70_000, files=1)
    folder = scratch_path(spark, "records")
    index = token_files.write_records(docs, folder, BYTES, end_id=70_000, id_bytes=4, files=1)
    assert token_files.encoded_documents(index, folder).first()["ids_crc32"] == zlib.crc32(ids_of(BYTES, "one two", 70_000))
