import numpy as np
from llm.helpers import Groups
from pyspark.sql import functions as F

from clientgrain.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    units = {}
    for i, v, label in rows:
        u = None if label is None else vector_dedup.unit_vector(v)
        units[i] = (None if u is None else (label, len(u)), u)
    links, groups = dict.fromkeys(units, 0), Groups(units)
    by = {}
    for i, (k, u) in units.items():
        if k is not None:
            by.setdefault(k, []).append((i, u))
    for found in by.values():
        ids, x = [i for i, _ in found], np.array([u for _, u in found])
        close = np.triu(x @ x.T >= vector_dedup.THRESHOLD, 1)
        for a, b in zip(*np.nonzero(close)):
            links[ids[a]] += 1
            links[ids[b]] += 1
            groups.join(ids[a], ids[b])
    return {i: (links[i], groups.top(i), groups.top(i) == i) for i in units}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.1, 0.0], 1), (4, [1.0, 0.0, 0.0], 2), (5, [1.0, 0.0, 0.0], None),
            (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1), (9, [1.0, None, 0.0], 1), (10, [inf, 0.0, 0.0], 1), (11, [nan, 0.0, 0.0], 1),
            (12, [1.0, 0.0], 1), (13, [1.0, 0.0], 1), (14, [-1.0, 0.0, 0.0], 1), (15, [1e-30, 0.0, 0.0], 1), (16, [3.0], 1), (17, [4.0], 1), (-2, [1e30, 0.0, 0.0], 1)]
    df = spark.createDataFrame([*rows, rows[0], rows[2]], SCHEMA).select("*", *[F.lit(c).alias(c) for c in ("id", "unit", "key", "kept", "length", "copies")])
    assert result(vector_dedup.vector_dedup(df)) == brute(rows)
    nobody = spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], SCHEMA)
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in vector_dedup.vector_dedup(nobody).collect()) == [
        ("1", 0, 1, True), ("None", 0, None, True)]


def test_empty(spark):
    assert vector_dedup.vector_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_recall(spark):
    """Pairs around the threshold, a large cluster and exact copies against all pairs."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((700, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = []
    for cos in (0.932, 0.94, 0.96, 0.99):
        for v in x[:150]:
            w = rng.standard_normal(64)
            w -= (w @ v) * v
            near.append(cos * v + np.sqrt(1 - cos * cos) * w / np.linalg.norm(w))
    crowd = x[699] + 0.01 * rng.standard_normal((300, 64))
    every = np.concatenate([x, near, crowd, x[:20]]).astype(np.float32)
    rows = [(i, [float(c) for c in v], i % 3 % 2) for i, v in enumerate(every)]
    got, want = result(vector_dedup.vector_dedup(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.99 * sum(w[0] for w in want.values())


def test_recall_of_filters_for_large_labels():
    """Pairs just above the threshold alone, other than those the codes were sized with."""
    rng = np.random.default_rng(23)
    for length, largest, least in ((64, 100_000, 0.999), (64, 200, 0.999), (7, 5_000, 0.999)):
        filters = vector_dedup.Filters(length, largest)
        for cosine in (0.93, 0.94):
            one, two = vector_dedup.pairs_at(cosine, 1_500, length, rng)
            assert np.allclose((one * two).sum(axis=1), cosine)
            met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(filters.of(one), filters.of(two))]
            assert np.mean(met) >= least, (length, largest, cosine)
