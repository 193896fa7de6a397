"""Exact similarity inside candidate buckets, and what follows from the links.

Whoever fills the buckets (recursive splits, bands), the rest is the same.  A
pair is looked at in one bucket only, the lowest that both sets share.  Buckets
above ``BLOCK`` sets are cut into blocks, and each pair of blocks is a tile of
its own, so no task holds more than two blocks.  A first pass over the tiles
compares sketches and keeps the sets that may have a partner there; only these
carry their shingles into the second pass, which counts exactly.  Links are
counted and joined to trees inside the tile; pairs never leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_if_small, cut
from .texts import small_batches, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Sets of a bucket that one task holds together; two blocks meet in a tile.
BLOCK = 256
# Standard errors below the threshold at which a sketch still counts as a candidate.
SLACK = 5.0

MIX = np.uint64(0x9E3779B97F4A7C15)
# Any odd number has an inverse among the 64-bit numbers.
BASE = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(int(BASE), -1, 2 ** 64))
# A random number for each byte; sums of these, shifted by place, tell words apart.
BYTE_CODES = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    out = values * MIX
    return (out ^ (out >> np.uint64(29))) * MIX


def run_hashes(codes: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``codes[first:stop]``, all from the same running sums."""
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(codes), BASE)]))
    back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(codes), INVERSE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * power[:-1], dtype=np.uint64)])
    return mixed((sums[stop] - sums[first]) * back[first] + (stop - first).astype(np.uint64))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """64-bit hashes of words, made of their bytes all at once."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stop = np.cumsum(size)
    return run_hashes(BYTE_CODES[np.frombuffer(b"".join(words), dtype=np.uint8)], stop - size, stop)


def shingles(words: Sequence[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; fewer words are one run, none give none."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = word_hashes(words)
    n = max(1, len(h) - size + 1)
    run = np.full(n, min(size, len(h)), dtype=np.uint64)
    for i in range(min(size, len(h))):
        run = (run ^ h[i:i + n]) * MIX
        run ^= run >> np.uint64(29)
    run.sort()
    return run[np.concatenate([[True], run[1:] != run[:-1]])]


class Sketcher:
    """Minima of ``size`` fixed permutations over each set."""

    def __init__(self, size: int, dtype: str) -> None:
        rng = np.random.default_rng(20240607)
        self.a = (rng.integers(0, 2**31, size, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = rng.integers(0, 2**32, size, dtype=np.uint32)
        self.dtype = dtype

    def __call__(self, grams: np.ndarray) -> bytes:
        x = (grams >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 2**32 - 1, dtype=np.uint32)
        for at in range(0, len(x), 4096):
            low = np.minimum(low, (x[at:at + 4096, None] * self.a + self.b).min(axis=0))
        # The lowest minimum is 0 more often than any other; the low bits are even.
        return (low * np.uint32(0x85EBCA6B) ^ (low >> np.uint32(13))).astype(self.dtype).tobytes()


def digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys`` as tables of whole groups, with each row's group number."""
    pending: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([pending, now]) if pending is not None else now
        if not now.num_rows:
            continue
        changed = np.zeros(now.num_rows, dtype=bool)
        for k in keys:
            column = now.column(k).to_numpy()
            changed[1:] |= column[1:] != column[:-1]
        numbers = np.cumsum(changed)
        last = int(np.searchsorted(numbers, numbers[-1]))
        if last:
            yield now.slice(0, last).combine_chunks(), numbers[:last]
        pending = now.slice(last)
    if pending is not None and pending.num_rows:
        yield pending.combine_chunks(), np.zeros(pending.num_rows, dtype=np.int64)


def bytes_matrix(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1)


def padded(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of ascending numbers as rows of a matrix; the padding is unlike any number of another row."""
    rows = column.to_pylist()
    out = np.empty((len(rows), max(map(len, rows))), dtype=np.int64)
    blank = np.arange(len(rows), dtype=np.int64) + np.iinfo(np.int64).min
    out[:] = blank[:, None]
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def meets_first(keys: np.ndarray, i: np.ndarray, j: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Whether ``here`` is the lowest key that rows i and j share."""
    out = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 20_000):
        part = slice(at, at + 20_000)
        a = keys[i[part]]
        shared = (a[:, :, None] == keys[j[part]][:, None, :]).any(axis=2)
        out[part] = a[np.arange(len(a)), shared.argmax(axis=1)] == here[part]
    return out


def pairs_within(numbers: np.ndarray, blocks: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of the same group, by distance; in tiles of two blocks only pairs across them."""
    n = len(numbers)
    for shift in range(1, n):
        i = np.nonzero(numbers[shift:] == numbers[:n - shift])[0]
        if not len(i):
            return
        j = i + shift
        use = ~cross[i] | (blocks[i] != blocks[j])
        yield i[use], j[use]


def may_pair(threshold: float, sketch_size: int, dtype: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    least = max(1.0, np.floor(sketch_size * threshold - SLACK * np.sqrt(sketch_size * threshold * (1 - threshold))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, numbers in groups(batches, ("key", "tile")):
            sketch = bytes_matrix(table.column("sketch"), dtype)
            size = table.column("size").to_numpy().astype(float)
            here, tile, block = (table.column(c).to_numpy() for c in ("key", "tile", "block"))
            keys = padded(table.column("keys"))
            active = np.zeros(len(numbers), dtype=bool)
            for i, j in pairs_within(numbers, block, tile % 2 == 1):
                use = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
                i, j = i[use], j[use]
                use = (sketch[i] == sketch[j]).sum(axis=1) >= least
                i, j = i[use], j[use]
                if len(i):
                    use = meets_first(keys, i, j, here[i])
                    active[i[use]] = active[j[use]] = True
            kept = table.filter(pa.array(active)).select(["key", "tile", "block", "id", "size", "copies", "keys"])
            yield from kept.to_batches()

    return run


def roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """The lowest row reachable from each row."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def shared_counts(grams: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, exactly."""
    n = len(grams)
    if n == 2:
        return np.array([[0, s := len(np.intersect1d(grams[0], grams[1], assume_unique=True))], [s, 0]])
    owner = np.repeat(np.arange(n), [len(g) for g in grams])
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    number = np.cumsum(new) - 1
    common = np.bincount(number) > 1
    use = common[number]
    column = (np.cumsum(common) - 1)[number[use]]
    owner = owner[use]
    out = np.zeros((n, n), dtype=np.float64)
    total, step = int(common.sum()), 8192
    starts = np.searchsorted(column, np.arange(0, total + step, step))
    for c, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        if a < b:
            hit = np.zeros((n, min(step, total - c * step)), dtype=np.float32)
            hit[owner[a:b], column[a:b] - c * step] = 1
            out += hit @ hit.T
    return out


def count_links(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, numbers in groups(batches, ("key", "tile")):
            ids, grams_of, copies_of = (table.column(c).to_pylist() for c in ("id", "grams", "copies"))
            tile, block, here = (table.column(c).to_numpy() for c in ("tile", "block", "key"))
            keys = padded(table.column("keys"))
            out: list[tuple[bytes, int, bytes]] = []
            edges = np.concatenate([np.nonzero(np.diff(numbers))[0] + 1, [len(numbers)]])
            first = 0
            for last in edges.tolist():
                # A repeated input row brings its set twice.
                rows = sorted({ids[r]: r for r in range(first, last)}.values(), key=lambda r: ids[r])
                first = last
                if len(rows) < 2:
                    continue
                grams = [np.frombuffer(grams_of[r], dtype=np.uint64) for r in rows]
                size = np.array([len(g) for g in grams], dtype=np.float64)
                shared = shared_counts(grams)
                i, j = np.nonzero(np.triu(shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9, 1))
                at = np.array(rows)
                use = meets_first(keys, at[i], at[j], here[at[i]]) if len(i) else np.zeros(0, dtype=bool)
                if tile[rows[0]] % 2 == 1:
                    use &= block[at[i]] != block[at[j]]
                i, j = i[use], j[use]
                if not len(i):
                    continue
                copies = np.array([copies_of[r] for r in rows], dtype=np.int64)
                linked = np.zeros(len(rows), dtype=np.int64)
                np.add.at(linked, i, copies[j])
                np.add.at(linked, j, copies[i])
                up = roots(len(rows), i, j)
                out += [(ids[rows[k]], int(linked[k]), ids[rows[up[k]]]) for k in np.nonzero(linked)[0].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], type=pa.binary()), pa.array([o[1] for o in out], type=pa.int64()),
                                              pa.array([o[2] for o in out], type=pa.binary())], names=["id", "linked", "root"])

    return run


def tiled(members: DataFrame) -> DataFrame:
    """Rows (id, key, n) to one row (id, key, block, tile) for each tile of the bucket the set belongs to.

    A bucket of at most ``BLOCK`` sets is one tile.  In larger ones sets are
    blocked by home, the lowest large bucket a set is in: two sets of one home
    meet there, so only blocks of different homes, or of sets at home, need a
    tile in other buckets.  Copies that share most buckets are thus compared in
    one of them.  ``tile`` is even for a block by itself and odd for two blocks.
    """
    small = members.where(F.col("n") <= BLOCK).select("id", "key", F.lit(0).alias("block"), F.lit(0).cast("long").alias("tile"))
    large = members.where(F.col("n") > BLOCK)
    home = large.groupBy("id").agg(F.min("key").alias("home"))
    large = cut(large.select("id", "key").join(home, "id"))
    # Guests from homes with few sets here are blocked together, as if at home: they meet everybody.
    few = large.groupBy("key", "home").agg(F.count("*").alias("guests")).where(F.col("guests") < BLOCK).select("key", "home", F.lit(True).alias("few"))
    large = cut(large.join(few, ["key", "home"], "left").select("id", "key", F.when(F.col("few"), F.col("key")).otherwise(F.col("home")).alias("home")))
    parts = large.groupBy("key", "home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    first = F.sum("parts").over(Window.partitionBy("key").orderBy("home")) - F.col("parts")
    parts = cut(parts.select("key", "home", "parts", first.cast("int").alias("first"), F.sum("parts").over(Window.partitionBy("key")).alias("all")))
    n = parts.count()
    if not n:
        return small
    blocks = cut(parts.select("key", F.col("home").alias("other_home"), F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("other")))
    placed = (large.join(broadcast_if_small(parts, n), ["key", "home"])
              .withColumn("block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))
    met = (placed.join(broadcast_if_small(blocks, blocks.count()), "key")
           .where((F.col("home") == F.col("key")) | (F.col("other_home") == F.col("key")) | (F.col("home") != F.col("other_home"))))
    low, high = F.least("block", "other").cast("long"), F.greatest("block", "other")
    return small.unionByName(met.select("id", "key", "block", ((low * F.col("all") + high) * 2 + (low != high).cast("long")).cast("long").alias("tile")))


def linked_sets(items: DataFrame, entries: DataFrame, sets: Callable[[DataFrame], DataFrame],
                threshold: float = THRESHOLD, sketch_size: int = 64, dtype: str = "<u4") -> DataFrame:
    """(id, linked, root): for each tile a set has partners in, their copies and the lowest id it is joined to.

    ``items`` has id (binary), size, copies and sketch; ``entries`` the distinct
    (id, key) of all buckets, a bounded number for each id; ``sets`` gives
    (id, grams) for a table of ids.  Every pair that shares a bucket and is
    similar enough by exact count is a link.
    """
    small_batches(items.sparkSession, 2_000)
    counts = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(entries.join(counts, "key"))
    keys = members.groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    facts = items.select("id", "size", "copies", "sketch").join(keys, "id")
    rows = tiled(members).join(facts, "id").repartition("key", "tile").sortWithinPartitions("key", "tile")
    active = cut(rows.mapInArrow(may_pair(threshold, sketch_size, dtype),
                                 "key long, tile long, block int, id binary, size int, copies long, keys array<long>"))
    grams = sets(active.select("id").distinct())
    whole = active.join(grams, "id").select("key", "tile", "block", "id", "copies", "keys", "grams")
    small_batches(items.sparkSession, 500)
    return cut(whole.repartition("key", "tile").sortWithinPartitions("key", "tile")
               .mapInArrow(count_links(threshold), "id binary, linked long, root binary"))


def components(edges: DataFrame, a: str = "id", b: str = "root") -> DataFrame:
    """(id, component): the lowest id that each id of the edges reaches.

    Every round takes the lowest label among neighbours and then the label's own
    label, so long chains shrink by halves.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x != y").distinct()
    both = cut(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("id"), F.least("x", "m").alias("component")))
    while True:
        near = (both.join(labels.select(F.col("id").alias("y"), "component"), "y")
                .groupBy(F.col("x").alias("id")).agg(F.min("component").alias("near")))
        lower = cut(labels.join(near, "id").select("id", F.least("component", "near").alias("component"), F.col("component").alias("was")))
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("next"))
        after = cut(lower.join(jump, "component").select("id", F.least("component", "next").alias("component"),
                                                         (F.least("component", "next") != F.col("was")).alias("moved")))
        labels = after.select("id", "component")
        if after.where("moved").isEmpty():
            return labels


def gram_sets(docs: DataFrame, ids: DataFrame, of_text: Callable[[], Callable[[str | None], Iterable[tuple[bytes, np.ndarray]]]]) -> DataFrame:
    """(id, grams) made anew from the texts of ``docs``, for the wanted ids only.

    ``ids`` has id and the ``doc_id`` whose text holds it; ``of_text`` makes the
    function that gives a text's (id, shingles).
    """
    wanted = ids.groupBy("doc_id").agg(F.collect_set("id").alias("wanted"))
    rows = docs.select("doc_id", "text").join(wanted, "doc_id").select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets_of = of_text()
        for batch in batches:
            out = []
            for text, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                want = set(want)
                out += [(i, g.tobytes()) for i, g in sets_of(text) if i in want]
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], type=pa.binary()), pa.array([o[1] for o in out], type=pa.binary())],
                                             names=["id", "grams"])

    return rows.mapInArrow(run, "id binary, grams binary")


def path_key(path: Column, position: Column, sketch: Column, width: int) -> Column:
    return F.xxhash64(path, position, F.substring(sketch, position * width + 1, F.lit(width)))
