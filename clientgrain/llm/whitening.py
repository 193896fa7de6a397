"""Whitening of integer vectors by exact bit-sliced scatter sums.

Entries become whole numbers.  In a block of rows each dimension is shifted to
start at 0 and cut into bit planes; a plane's bits of 64 rows are one word.  The
ANDed words of two planes, counted, say in how many rows both bits are set; added
up with the planes' weights this gives the sums of products, exactly.  Blocks are
added up as whole numbers of any size, centred as such (``n * P - S * S'``), and
only then become floating point for the eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut
from .texts import small_batches

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# Rows whose planes are held at once; 64 rows are a word.
BLOCK_ROWS = 4096
# Rows that travel to a worker at once.
BATCH_ROWS = 4096
# Entries beyond have no long.
LARGEST = 2.0 ** 56
# Sums travel as three parts of so many bits, so that Spark can add them as longs.
PART_BITS = 42
PART = (1 << PART_BITS) - 1
# Bytes of ANDed words held at once.
HELD = 1 << 23
# Components whose variance is below this share of the largest are rounding.
LEAST_SHARE = 1e-13

SUMS = "i int, j int, low long, middle long, high long"


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes of rows of whole numbers from 0: (planes, dimensions, words)."""
    n, _ = values.shape
    bits = max(1, int(values.max()).bit_length())
    full = np.zeros((-(-n // 64) * 64, values.shape[1]), dtype=np.uint64)
    full[:n] = values
    turned = np.ascontiguousarray(full.T)
    return np.stack([np.packbits(((turned >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64) for b in range(bits)])


def both_set(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many rows bit i of one plane and bit j of the other are set, for all dimensions i and j."""
    dims, words = a.shape
    out = np.empty((dims, dims), dtype=np.int64)
    step = max(1, HELD // (8 * dims * words))
    for i in range(0, dims, step):
        out[i:i + step] = np.bitwise_count(a[i:i + step, None, :] & b[None]).sum(axis=2, dtype=np.int64)
    return out


def scatter(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each dimension and of the products of each two over int64 rows, as Python's whole numbers."""
    n, dims = rows.shape
    least = rows.min(axis=0)
    planes = planes_of((rows - least).astype(np.uint64))
    own = np.zeros(dims, dtype=object)
    product = np.zeros((dims, dims), dtype=object)
    for a, plane in enumerate(planes):
        own += np.bitwise_count(plane).sum(axis=1, dtype=np.int64).astype(object) << a
        for b in range(a, len(planes)):
            both = both_set(plane, planes[b])
            product += ((both + both.T) if b > a else both).astype(object) << (a + b)
    least = least.astype(object)
    product += np.outer(least, own) + np.outer(own, least) + n * np.outer(least, least)
    return own + n * least, product


def parts_of(value: int) -> tuple[int, int, int]:
    return value & PART, value >> PART_BITS & PART, value >> 2 * PART_BITS


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass(frozen=True)
class Whitening:
    """What was learnt from the distinct vectors: their number, sums (less the shift) and leading components."""

    n: int
    sums: list[int]
    components: np.ndarray          # a column for each
    variances: np.ndarray
    explained: np.ndarray

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (rows - mean) @ self.components / np.sqrt(self.variances)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, null where no long holds it."""
        largest = self.n * int(np.abs(rows).max(initial=0)) + max(map(abs, self.sums))
        if len(self.sums) * largest ** 2 < 2 ** 63:
            return ((self.n * rows - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * rows.astype(object) - np.array(self.sums, dtype=object)) ** 2).sum(axis=1)
        return [int(d) if d < 2 ** 63 else None for d in exact]


def entries(vector: Column) -> Column:
    """Whole entries less the shift; they differ from x by a constant only."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST)), F.lit(False))


def narrow_type(largest: int) -> str:
    return next(t for t, bits in (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)) if largest < 2 ** bits)


def fit_sums(distinct: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and sums of products of the distinct vectors ``f``; as many numbers come back as a vector has pairs of dimensions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, own, product = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        for batch in batches:
            values = matrix(batch.column(0), dims).astype(np.int64)
            for at in range(0, len(values), BLOCK_ROWS):
                block = values[at:at + BLOCK_ROWS]
                sums, products = scatter(block)
                n, own, product = n + len(block), own + sums, product + products
        if n:
            found = [(-1, -1, n), *[(i, -1, int(own[i])) for i in range(dims)],
                     *[(i, j, int(product[i, j])) for i in range(dims) for j in range(i, dims)]]
            columns = list(zip(*[(i, j, *parts_of(v)) for i, j, v in found]))
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=["i", "j", "low", "middle", "high"])

    rows = (distinct.select("f").mapInArrow(run, SUMS).groupBy("i", "j")
            .agg(*[F.sum(c).alias(c) for c in ("low", "middle", "high")]).collect())
    total = {(r["i"], r["j"]): r["low"] + (r["middle"] << PART_BITS) + (r["high"] << 2 * PART_BITS) for r in rows}
    return (total.get((-1, -1), 0), [total.get((i, -1), 0) for i in range(dims)],
            [[total.get((min(i, j), max(i, j)), 0) for j in range(dims)] for i in range(dims)])


def fitted(distinct: DataFrame, dims: int, components: int) -> Whitening:
    n, sums, products = fit_sums(distinct, dims)
    # Whole numbers until the division, which Python rounds correctly.
    covariance = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    use = int((values[:components] > LEAST_SHARE * max(values[0], 0)).sum()) if values[0] > 0 else 0
    return Whitening(n, sums, vectors[:, :use], values[:use], values[:use] / np.trace(covariance) if use else values[:0])


def identity_error(distinct: DataFrame, model: Whitening, dims: int) -> float:
    """Largest entry of the whitened distinct vectors' covariance less the identity, from the vectors themselves."""
    k = len(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, product = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            white = model(matrix(batch.column(0), dims).astype(np.float64))
            own, product = own + white.sum(axis=0), product + white.T @ white
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.arange(k), i]).astype(np.int32)), pa.array(np.concatenate([np.full(k, -1), j]).astype(np.int32)),
                                          pa.array(np.concatenate([own, product[i, j]]))], names=["i", "j", "total"])

    rows = distinct.select("f").mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    mean = {r["i"]: r["total"] / model.n for r in rows if r["j"] < 0}
    return max((abs(r["total"] / model.n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in rows if r["j"] >= 0), default=0.0)


def whitening(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Each entry c becomes x = floor(64 * c) + 1000000.  The distinct x vectors
    are the ``n`` vectors of the fit, so repeated rows and vectors count once
    but all come out.  Vectors that are null or empty, or hold null, non-finite
    or entries of 2 ** 56 and more (of which no long can be made) are left out;
    so are those whose length is not the most frequent one (of two, the shorter).
    Components without variance are left out: one distinct vector, equal
    entries everywhere, and an empty table give an empty result.  A deviation
    that no long holds is null.  A null id stays null.  Other columns are
    ignored.  The square of the vectors' length goes through the driver.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").alias("v")).where(usable(F.col("v")))
    whole = slim.select("vec_id", entries(F.col("v")).alias("f"))
    lengths = whole.groupBy(F.size("f").alias("dims")).agg(F.count("*").alias("times"), F.max(F.greatest(F.array_max("f"), -F.array_min("f"))).alias("largest"))
    chosen = lengths.orderBy(F.desc("times"), "dims").first()
    out = T.StructType([T.StructField("vec_id", vectors.schema[id_col].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    if chosen is None:
        return spark.createDataFrame([], out)
    dims = chosen["dims"]
    rows = whole.where(F.size("f") == dims).select("vec_id", F.col("f").cast(f"array<{narrow_type(chosen['largest'])}>").alias("f"))
    small_batches(spark, BATCH_ROWS)
    distinct = cut(rows.select("f").distinct())
    model = fitted(distinct, dims, components)
    k = len(model.variances)
    error = identity_error(distinct, model, dims) if k else 0.0
    names = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column(1), dims).astype(np.int64)
            n, white = len(values), model(values.astype(np.float64))
            each = np.repeat(np.arange(n), k)
            deviation = pa.array(model.deviations(values), type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, model.n)),
                 deviation.take(pa.array(each)), pa.array(white.reshape(-1)), pa.array(np.tile(model.explained, n)), pa.array(np.full(n * k, error))],
                schema=names)

    return rows.mapInArrow(run, out) if k else spark.createDataFrame([], out)
