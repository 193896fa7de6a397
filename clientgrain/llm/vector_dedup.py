"""Near-duplicate vectors of equal label, by spherical-cap filters.

A filter is a direction with a cap around it; a vector is stored at all filters
whose cap it lies in, and close vectors share filters with high probability.
The directions form a product code: every pair of a left and a right code vector
is one direction, so a vector finds all its filters from the two short lists of
block scores, without looking at the others.  Vectors that share a filter are
compared exactly.

The size of a code and the cap follow the largest label, so that a filter holds
a few unrelated vectors of a label at any size.  The filters of one code depend
on each other, so how many codes the recall takes is measured: each code is
turned at random, so that random pairs at the threshold tell for any pair how
often one code misses it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .buckets import bytes_matrix, components, groups, meets_first, padded, roots, tiled
from .texts import small_batches

THRESHOLD = 0.93
# Of the pairs at the threshold this share meets in a filter.
RECALL = 0.9999
# Unrelated vectors of the largest label that a filter holds on average.
CROWD = 8.0
SEED = 7
# Independent product codes, at least.  In one code the filters of a vector depend
# on each other: some vectors would lie in very few caps.
CODES = 6
# Random pairs for each of these codes, to measure how often a code misses a pair.
TRIALS = 1_000


def tail(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2))


def cap_for(share: float) -> float:
    """The normal score that ``share`` of all vectors exceed."""
    low, high = -8.0, 8.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > share else (low, mid)
    return low


def follows(cap: float, threshold: float) -> float:
    """How likely a vector at the threshold's angle lies in the cap its partner lies in."""
    x = np.linspace(cap, cap + 8, 4001)
    density = np.exp(-x * x / 2)
    beyond = np.array([tail((cap - threshold * v) / math.sqrt(1 - threshold ** 2)) for v in x])
    return float((density * beyond).sum() / density.sum())


class Filters:
    """The product codes for vectors of one length.

    A vector that lies in no cap of a code takes the nearest direction of it.
    """

    def __init__(self, length: int, largest: int, threshold: float = THRESHOLD, recall: float = RECALL) -> None:
        share = min(0.05, CROWD / max(1, largest))
        cap = cap_for(share)
        needed = -math.log(1 - recall) / follows(cap, threshold)
        self.size = max(2, math.ceil(math.sqrt(needed / share / CODES)))
        self.half = length // 2
        # Scores of the two halves add up; each has variance 1 / length.
        self.least = cap * math.sqrt(2.0 / length)
        self.length = length
        rng = np.random.default_rng(SEED)
        self.codes = [self.code(rng) for _ in range(CODES)]
        missed = self.missed(threshold)
        more = 0 if missed <= 0 else math.ceil(math.log(1 - recall) / math.log(missed)) - CODES
        self.codes += [self.code(rng) for _ in range(more)]

    def code(self, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (np.linalg.qr(rng.standard_normal((self.length, self.length)))[0], self.directions(rng, self.half),
                self.directions(rng, self.length - self.half))

    def missed(self, threshold: float) -> float:
        """The share of random pairs at the threshold that meet in no filter of one code, and two standard errors."""
        if self.length < 2:
            return 0.0  # only equal vectors are close
        rng = np.random.default_rng(SEED + 1)
        n = TRIALS * len(self.codes)
        misses = 0
        for c in range(len(self.codes)):
            one, two = pairs_at(threshold, TRIALS, self.length, rng)
            misses += sum(not len(np.intersect1d(a, b)) for a, b in zip(self.hits(c, one), self.hits(c, two)))
        share = misses / n
        # At least three misses: none in n trials is no proof of none.
        return min(0.99, max(share, 3 / n) + 2 * math.sqrt(share * (1 - share) / n))

    def directions(self, rng: np.random.Generator, length: int) -> np.ndarray:
        found = rng.standard_normal((self.size, length))
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)

    def of(self, unit: np.ndarray) -> list[np.ndarray]:
        """The numbers of all filters of each unit vector."""
        found = zip(*[self.hits(c, unit) for c in range(len(self.codes))])
        return [np.concatenate(f).astype(np.int64) for f in found]

    def hits(self, c: int, unit: np.ndarray) -> list[np.ndarray]:
        """The numbers of the filters of one code."""
        turn, left, right = self.codes[c]
        turned = unit @ turn
        scores, others = turned[:, :self.half] @ left.T, turned[:, self.half:] @ right.T
        order = np.argsort(-others, axis=1)
        first = c * self.size ** 2
        found = []
        for a, b, o in zip(scores, others, order):
            reach = np.searchsorted(-b[o], a - self.least, side="right")
            hit = np.nonzero(reach)[0]
            if len(hit):
                found.append(np.concatenate([first + i * self.size + o[:reach[i]] for i in hit.tolist()]))
            else:
                found.append(np.array([first + int(a.argmax()) * self.size + o[0]]))
        return found


def pairs_at(cosine: float, n: int, length: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors with this cosine."""
    one, other = rng.standard_normal((2, n, length))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (other * one).sum(axis=1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return one, cosine * one + math.sqrt(max(0.0, 1 - cosine * cosine)) * other


def unit_vector(values: list | None) -> np.ndarray | None:
    """The vector over its length, or None where it has none."""
    if not values or any(v is None for v in values):
        return None
    v = np.array(values, dtype=np.float64)
    if not np.isfinite(v).all():
        return None
    largest = np.abs(v).max()
    if largest == 0:
        return None
    v /= largest
    return v / np.linalg.norm(v)


def facts(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, id, length, unit): ``id`` is a digest of label and vector, null where nothing can link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, values in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                v = None if label is None else unit_vector(values)
                packed = None if v is None else v.astype("<f8").tobytes()
                out.append((None, None, None) if v is None else (xxhash.xxh3_128_digest(str(label).encode() + b"\0" + packed), len(v), packed))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array([o[i] for o in out], type=t) for i, t in
                                              enumerate((pa.binary(), pa.int32(), pa.binary()))]], names=["vec_id", "label", "id", "length", "unit"])

    return vectors.mapInArrow(run, "vec_id long, label string, id binary, length int, unit binary")


def filter_entries(items: DataFrame, filters: dict[int, Filters]) -> DataFrame:
    """(id, place, key): the filters of each vector; ``key`` is a hash of label, length and filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).to_numpy()
            units = batch.column(2).to_pylist()
            found: list[np.ndarray | None] = [None] * len(units)
            for length in set(lengths.tolist()):
                rows = np.nonzero(lengths == length)[0]
                unit = np.frombuffer(b"".join([units[r] for r in rows]), dtype="<f8").reshape(len(rows), -1)
                for r, hit in zip(rows, filters[length].of(unit)):
                    found[r] = hit
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.list_(pa.int64()))], names=["id", "found"])

    made = items.select("id", "length", "unit").mapInArrow(run, "id binary, found array<long>")
    return (made.select("id", F.explode("found").alias("filter")).join(items.select("id", "label", "length"), "id")
            .select("id", F.xxhash64("label", "length", "filter").alias("key")))


def compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, numbers in groups(batches, ("key", "tile")):
            ids, label, copies = (table.column(c).to_pylist() for c in ("id", "label", "copies"))
            key, tile, block, length = (table.column(c).to_numpy() for c in ("key", "tile", "block", "length"))
            units, keys = table.column("unit"), padded(table.column("keys"))
            out = []
            edges = np.concatenate([np.nonzero(np.diff(numbers))[0] + 1, [len(numbers)]])
            first = 0
            for last in edges.tolist():
                rows = np.array(sorted(range(first, last), key=ids.__getitem__))
                first = last
                if len(rows) < 2 or len(set(length[rows].tolist())) > 1:
                    continue  # one vector, or a clash of hashes between lengths: those never link
                unit = bytes_matrix(units.take(pa.array(rows)), "<f8")
                i, j = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
                a, b = rows[i], rows[j]
                use = np.array([label[x] == label[y] for x, y in zip(a.tolist(), b.tolist())], dtype=bool)
                if tile[rows[0]] % 2 == 1:
                    use &= block[a] != block[b]
                i, j = i[use], j[use]
                if not len(i):
                    continue
                use = meets_first(keys, rows[i], rows[j], key[rows[i]])
                i, j = i[use], j[use]
                weight = np.array([copies[r] for r in rows.tolist()], dtype=np.int64)
                linked = np.zeros(len(rows), dtype=np.int64)
                np.add.at(linked, i, weight[j])
                np.add.at(linked, j, weight[i])
                up = roots(len(rows), i, j)
                out += [(ids[rows[k]], int(linked[k]), ids[rows[up[k]]]) for k in np.nonzero(linked)[0].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([o[n] for o in out], type=t) for n, t in
                                              enumerate((pa.binary(), pa.int64(), pa.binary()))], names=["id", "linked", "root"])

    return run


def vector_dedup(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "vec_id",
                 vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    Links join vectors of equal, non-null label with a cosine of at least
    ``threshold`` in double precision.  Null, empty and zero vectors and those
    with null or non-finite components link with nothing, nor do vectors of
    different length.  Repeated rows count once; an id with several vectors has
    a row for each.  Rows without id come out unlinked, with null ids.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2_000)
    found = cut(facts(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                                     F.col(vector).cast("array<double>").alias("v"))))
    items = cut(found.where("id IS NOT NULL AND vec_id IS NOT NULL").groupBy("id").agg(
        F.min("vec_id").alias("vec_id"), F.count_distinct("vec_id").alias("copies"),
        *[F.first(c).alias(c) for c in ("label", "length", "unit")]))
    # One row for each vector length: the size of the largest label.
    largest = (items.groupBy("length", "label").agg(F.count("*").alias("n")).groupBy("length").agg(F.max("n").alias("n")).collect())
    filters = {r["length"]: Filters(r["length"], r["n"], threshold, recall) for r in largest}
    entries = cut(filter_entries(items, filters))
    counts = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(entries.join(counts, "key"))
    keys = members.groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    rows = (tiled(members).join(items.select("id", "label", "length", "copies", "unit").join(keys, "id"), "id")
            .repartition("key", "tile").sortWithinPartitions("key", "tile"))
    links = cut(rows.select("key", "tile", "block", "id", "label", "length", "copies", "unit", "keys")
                .mapInArrow(compare(threshold), "id binary, linked long, root binary"))
    counted = links.groupBy("id").agg(F.sum("linked").alias("linked"))
    reach = components(links)
    least = reach.join(items.select("id", "vec_id"), "id").groupBy("component").agg(F.min("vec_id").alias("least"))
    of_item = (items.select("id", "vec_id", "copies").join(counted, "id", "left").join(reach, "id", "left").join(least, "component", "left")
               .select("id", F.coalesce("least", "vec_id").alias("least"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("linked")))
    has = F.col("vec_id").isNotNull()
    component = F.when(has, F.coalesce("least", "vec_id"))
    return (found.select("vec_id", "id").distinct().join(of_item, "id", "left")
            .select("vec_id", F.when(has, F.coalesce("linked", F.lit(0))).otherwise(0).alias("n_links"), component.alias("component_id"),
                    F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")))
