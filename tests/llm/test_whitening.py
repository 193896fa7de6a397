import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientgrain.llm import whitening as WH
from clientgrain.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def integers(v):
    return [math.floor(64 * c) + 1_000_000 for c in v]


def reference(rows, k=16):
    """(n, deviations by position, eigenvalues, explained, whitened by position) by definition, in whole numbers."""
    xs = [integers(v) for v in rows]
    fit = [list(x) for x in sorted(set(map(tuple, xs)))]
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    cov = np.array([[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) / n**3 for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = [[sum((n * x[d] - sums[d]) / n * vectors[d, c] for d in range(dims)) / math.sqrt(values[c]) for c in range(len(values))] for x in xs]
    return n, [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in xs], values / np.trace(cov), white


def check(spark, vectors, k=16):
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)], SCHEMA)
    rows = WH.whitening(df, k).collect()
    n, deviations, explained, white = reference(vectors, k)
    assert len(rows) == len(vectors) * len(explained)
    sign = {}
    for r in rows:
        w = white[r.vec_id][r.component - 1]
        assert (r.n, r.deviation) == (n, deviations[r.vec_id])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(w), rel=1e-6, abs=1e-7)
        if abs(w) > 1e-3:
            assert sign.setdefault(r.component, r.whitened / w > 0) == (r.whitened / w > 0)
        assert 0 <= r.identity_error < 1e-9
    assert len({r.identity_error for r in rows}) == 1


def test_by_definition(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)) * 0.3
    check(spark, [*vectors.tolist(), *vectors[:40].tolist()])


def test_more_components_than_dimensions_and_large_entries(spark):
    rng = np.random.default_rng(5)
    check(spark, (rng.normal(size=(50, 3)) * [1e3, 1.0, 300.0]).tolist())
    check(spark, (rng.normal(size=(200, 20))).tolist(), 4)


def test_scatter_is_exact():
    rng = random.Random(1)
    for n, dims, low, high in ((1, 1, 0, 0), (3, 2, -5, 5), (64, 3, 0, 1), (65, 4, -2**55, 2**55), (200, 5, 10**6, 10**6 + 90)):
        rows = [[rng.randint(low, high) for _ in range(dims)] for _ in range(n)]
        sums, products = WH.scatter(np.array(rows, dtype=np.int64))
        assert sums.tolist() == [sum(r[i] for r in rows) for i in range(dims)]
        assert products.tolist() == [[sum(r[i] * r[j] for r in rows) for j in range(dims)] for i in range(dims)]


def test_parts_hold_any_sign():
    for v in (0, 1, -1, 2**100 + 12345, -2**100 - 12345):
        low, middle, high = WH.parts_of(v)
        assert low + (middle << WH.PART_BITS) + (high << 2 * WH.PART_BITS) == v
        assert all(abs(p) < 2**63 for p in (low, middle, high))


def test_rows_left_out(spark):
    good = [[0.1, 0.5], [0.3, -0.2], [0.9, 0.4], [0.1, 0.5]]
    bad = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, None) for i, v in enumerate([*good, *bad])] + [(None, [0.7, 0.7], 1), (0, [0.1, 0.5], None)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("f", "v", "n", "component", "dims")])
    found = WH.whitening(df).collect()
    assert sorted([(r.vec_id, r.component) for r in found], key=str) == sorted([(i, c) for i in (0, 1, 2, 3, None, 0) for c in (1, 2)], key=str)
    assert {r.n for r in found} == {4}


def test_no_variance_and_empty(spark):
    same = spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], SCHEMA)
    assert WH.whitening(same).collect() == []
    assert WH.whitening(same.limit(0)).collect() == []
    line = spark.createDataFrame([(i, [i * 1.0, i * 1.0], 0) for i in range(5)], SCHEMA)
    assert {r.component for r in WH.whitening(line).collect()} == {1}


def test_deviation_beyond_long_is_null():
    model = WH.Whitening(3, [0, 0], np.eye(2), np.ones(2), np.ones(2))
    assert model.deviations(np.array([[2**55, 0], [1, 2]])) == [None, 45]


def test_given_table(spark, tiny):
    rows = QUERIES["op11_whitening"](spark, tiny).collect()
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()}
    keys = sorted(vectors)
    n, deviations, explained, white = reference([vectors[i] for i in keys])
    place = {v: i for i, v in enumerate(keys)}
    assert len(rows) == 16 * len(vectors)
    for r in rows:
        assert (r.n, r.deviation) == (n, deviations[place[r.vec_id]])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert abs(r.whitened) == pytest.approx(abs(white[place[r.vec_id]][r.component - 1]), rel=1e-5, abs=1e-6)
        assert r.identity_error < 1e-9
