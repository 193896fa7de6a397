"""Statistics of the positions of an array column, whole batches at a time.

Rows of a hundred numbers each are costly as (position, value) rows and as
expressions over their entries.  Here a Spark task reads them as Arrow batches,
numpy adds up what a statistic needs for each position, and the tasks' partial
results, whose size depends on the number of positions alone, are merged by
Spark aggregations.

What runs in a task are closures over numbers, so executors need numpy and
pyarrow and nothing of this package.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A pass of the quantile search splits a range of doubles into up to this many cells.
CELL_BITS = 10

Block = tuple[np.ndarray, np.ndarray]        # values and whether they are known, a row for each position
Prepare = Callable[[np.ndarray, np.ndarray], Block]


def scan(arrays: DataFrame, n: int, summarise: Callable[[Iterator[Block]], Iterator[dict]], schema: str, prepare: Prepare | None = None) -> DataFrame:
    """What each task's rows come to; ``arrays`` has one column of arrays of ``n`` numbers."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for batch in batches:
            flat = batch.column(0).flatten()
            if len(flat):
                values = np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, n).T)
                known = np.ascontiguousarray(flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, n).T)
                yield prepare(values, known) if prepare else (values, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for found in summarise(blocks(batches)):
                yield pa.RecordBatch.from_pydict(found)

    return arrays.mapInArrow(run, schema)


# --- what happens to values -------------------------------------------------

def bending() -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """``encoders.yeo_johnson`` for arrays."""
    def bent(x: np.ndarray, power: np.ndarray) -> np.ndarray:
        up = x >= 0
        exponent = np.where(up, power, 2.0 - power)
        size = np.abs(x)
        straight = np.abs(exponent) < 1e-12
        out = (np.power(size + 1.0, exponent) - 1.0) / exponent
        if straight.any():
            out = np.where(straight, np.log1p(size), out)
        return np.where(up, out, -out)
    return bent


def log_scaling() -> Callable[[np.ndarray], np.ndarray]:
    return lambda x: np.sign(x) * np.log1p(np.abs(x))


def filling(median: Sequence[float]) -> Prepare:
    middle = np.array(median, dtype=float)[:, None]
    return lambda values, known: (np.where(known, values, middle), np.ones_like(known))


def straightening(learned: dict) -> Prepare:
    """Filled, bent, centred and of unit variance."""
    fill, bent = filling(learned["median"]), bending()
    power, mean, deviation = (np.array(learned[k], dtype=float)[:, None] for k in ("power", "mean", "deviation"))

    def straight(values: np.ndarray, known: np.ndarray) -> Block:
        values, known = fill(values, known)
        return (bent(values, power) - mean) / deviation, known
    return straight


def scaled(learned: dict, x: Column) -> Column:
    """All steps of the learned scaling applied to a column of arrays."""
    straight = straightening(learned)
    center, scale = (np.array(learned[k], dtype=float)[:, None] for k in ("center", "scale"))
    n = len(center)

    def run(arrays: pa.Array) -> pa.Array:
        flat = arrays.flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, n).T
        known = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, n).T
        with np.errstate(all="ignore"):
            out = (straight(values, known)[0] - center) / scale
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n, dtype=np.int32)), pa.array(np.ascontiguousarray(out.T).ravel()))

    run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<double>")(x)


# --- moments ----------------------------------------------------------------

def moments(arrays: DataFrame, n: int, variants: Callable[[int, np.ndarray], np.ndarray | None], prepare: Prepare | None = None) -> dict:
    """Mean and variance of each variant of each position: {(slot, variant): (mean, variance)}.

    ``variants`` makes a matrix with a row for each variant of a position's
    known values.  Parts are merged around the common mean, so no digits cancel.
    """
    def summarise(blocks: Iterator[Block]) -> Iterator[dict]:
        parts: dict[int, list] = {}
        for values, known in blocks:
            for slot in range(n):
                x = values[slot][known[slot]]
                made = variants(slot, x) if len(x) else None
                if made is None:
                    continue
                rows, mean = made.shape[1], made.mean(axis=1)
                square = ((made - mean[:, None]) ** 2).sum(axis=1)
                if slot in parts:
                    had, old, spread = parts[slot]
                    both = had + rows
                    square = spread + square + (mean - old) ** 2 * (had * rows / both)
                    mean, rows = old + (mean - old) * (rows / both), both
                parts[slot] = [rows, mean, square]
        if parts:
            yield {"slot": [s for s, p in parts.items() for _ in p[1]], "variant": [i for p in parts.values() for i in range(len(p[1]))],
                   "n": [p[0] for p in parts.values() for _ in p[1]], "mean": [float(m) for p in parts.values() for m in p[1]],
                   "square": [float(s) for p in parts.values() for s in p[2]]}

    parts = scan(arrays, n, summarise, "slot long, variant long, n long, mean double, square double", prepare)
    whole = Window.partitionBy("slot", "variant")
    mean = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    spread = F.sum(F.col("square") + F.col("n") * F.pow(F.col("mean") - F.col("whole"), F.lit(2.0))) / F.sum("n")
    found = parts.withColumn("whole", mean).groupBy("slot", "variant").agg(F.first("whole").alias("mean"), spread.alias("variance"))
    return {(r["slot"], r["variant"]): (r["mean"], r["variance"]) for r in found.collect()}


def constants(arrays: DataFrame, n: int, prepare: Prepare | None = None) -> dict:
    """``encoders._constants`` of the positions of arrays."""
    log_scaled = log_scaling()

    def summarise(blocks: Iterator[Block]) -> Iterator[dict]:
        for values, known in blocks:
            of = [(i, values[i][known[i]]) for i in range(n) if known[i].any()]
            yield {"slot": [i for i, _ in of], "n": [len(x) for _, x in of], "tilt": [float(log_scaled(x).sum()) for _, x in of],
                   "low": [float(x.min()) for _, x in of], "high": [float(x.max()) for _, x in of]}

    found = (scan(arrays, n, summarise, "slot long, n long, tilt double, low double, high double", prepare)
             .groupBy("slot").agg(F.sum("n").alias("n"), F.sum("tilt").alias("tilt"), F.min("low").alias("low"), F.max("high").alias("high")))
    return {r["slot"]: (r["n"], r["tilt"], r["low"], r["high"]) for r in found.collect() if r["low"] < r["high"]}


def digests(arrays: DataFrame, n: int, known_constants: dict, cells: int, prepare: Prepare | None = None) -> dict:
    """``encoders._digests`` of the positions of arrays."""
    log_scaled = log_scaling()
    ranges = {slot: (float(log_scaled(np.float64(low))), float(log_scaled(np.float64(high)))) for slot, (_, _, low, high) in known_constants.items()}

    def summarise(blocks: Iterator[Block]) -> Iterator[dict]:
        count, total = np.zeros((n, cells + 1), dtype=np.int64), np.zeros((n, cells + 1))
        for values, known in blocks:
            for slot, (low, high) in ranges.items():
                x = values[slot][known[slot]]
                cell = np.clip(np.nan_to_num(np.floor((log_scaled(x) - low) / (high - low) * cells)), 0, cells).astype(np.int64)
                count[slot] += np.bincount(cell, minlength=cells + 1)
                total[slot] += np.bincount(cell, weights=x, minlength=cells + 1)
        slot, cell = np.nonzero(count)
        if len(slot):
            yield {"slot": slot, "cell": cell, "n": count[slot, cell], "total": total[slot, cell]}

    merged = (scan(arrays, n, summarise, "slot long, cell long, n long, total double", prepare)
              .groupBy("slot", "cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))).toArrow()
    slots, counts, totals = (merged.column(c).to_numpy() for c in ("slot", "n", "total"))
    return {s: (totals[slots == s] / counts[slots == s], counts[slots == s].astype(float)) for s in ranges}


def power_variances(arrays: DataFrame, n: int, grids: dict, prepare: Prepare | None = None) -> dict:
    """The variance of each position bent by each power of its grid: {slot: variances}."""
    grids = {slot: np.array(grid, dtype=float) for slot, grid in grids.items()}

    def variants(slot: int, x: np.ndarray) -> np.ndarray | None:
        if slot not in grids:
            return None
        power, size, up = grids[slot][:, None], np.log1p(np.abs(x)), x >= 0
        exponent = power if up.all() else 2.0 - power if not up.any() else np.where(up, power, 2.0 - power)
        out = (np.exp(exponent * size) - 1.0) / exponent
        straight = np.abs(exponent) < 1e-12
        if straight.any():
            out = np.where(straight, size, out)
        return out if up.all() else np.where(up, out, -out)

    found = moments(arrays, n, variants, prepare)
    return {slot: [found[slot, i][1] if (slot, i) in found else None for i in range(len(grid))] for slot, grid in grids.items()}


# --- quantiles --------------------------------------------------------------

def ordering() -> Callable[[np.ndarray], np.ndarray]:
    """Doubles as integers of the same order: one zero, and one not-a-number above all others."""
    def codes(values: np.ndarray) -> np.ndarray:
        bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
        return np.where(bits < 0, bits ^ np.int64(2 ** 63 - 1), bits)
    return codes


def _decoded(code: int) -> float:
    return float(np.int64(code if code >= 0 else code ^ (2 ** 63 - 1)).view(np.float64))


def array_quantiles(arrays: DataFrame, n: int, probs: Sequence[float], prepare: Prepare | None = None) -> list[list[float | None]]:
    """Exact quantiles of each position with linear interpolation; None where nothing is known.

    A wanted rank lies in a range of doubles.  A pass counts the values in each
    of the range's cells; the cell with the rank, cut to the values in it, is
    the next range.  Ten bits a pass end any search after seven passes; most
    take three or four, as cells soon hold single values.
    """
    codes = ordering()

    def extents(blocks: Iterator[Block]) -> Iterator[dict]:
        for values, known in blocks:
            of = [(i, codes(values[i][known[i]])) for i in range(n) if known[i].any()]
            yield {"slot": [i for i, _ in of], "n": [len(c) for _, c in of], "low": [int(c.min()) for _, c in of], "high": [int(c.max()) for _, c in of]}

    found = (scan(arrays, n, extents, "slot long, n long, low long, high long", prepare)
             .groupBy("slot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect())
    rows = {r["slot"]: r["n"] for r in found}
    ends = {r["slot"]: (r["low"], r["high"], 0) for r in found}
    places = {(slot, p): float(p) * (size - 1) for slot, size in rows.items() for p in probs}
    ranks = {(slot, rank): ends[slot] for (slot, _), place in places.items() for rank in (math.floor(place), math.ceil(place))}
    while True:
        ranges = sorted({(slot, low, high) for (slot, _), (low, high, _) in ranks.items() if low < high})
        if not ranges:
            break
        cells = _cells(arrays, n, ranges, codes, prepare)
        for (slot, rank), (low, high, before) in ranks.items():
            if low < high:
                count, least, most = cells[slot, low, high]
                upto = before + np.cumsum(count)
                at = int(np.searchsorted(upto, rank, side="right"))
                ranks[slot, rank] = (int(least[at]), int(most[at]), int(upto[at] - count[at]))

    def value(slot: int, prob: float) -> float | None:
        if slot not in rows:
            return None
        place = places[slot, prob]
        floor, ceil = math.floor(place), math.ceil(place)
        low, high = _decoded(ranks[slot, floor][0]), _decoded(ranks[slot, ceil][0])
        return low if floor == ceil else (ceil - place) * low + (place - floor) * high

    return [[value(slot, p) for p in probs] for slot in range(n)]


def _cells(arrays: DataFrame, n: int, ranges: list[tuple[int, int, int]], codes: Callable, prepare: Prepare | None) -> dict:
    """{range: (rows, least and most code) of its cells that hold any, in order}."""
    size = 2 ** CELL_BITS
    by_slot: dict[int, list] = {}
    for k, (slot, low, high) in enumerate(ranges):
        by_slot.setdefault(slot, []).append((k, low, high, max(0, (high - low).bit_length() - CELL_BITS)))
    n_ranges = len(ranges)

    def summarise(blocks: Iterator[Block]) -> Iterator[dict]:
        count = np.zeros((n_ranges, size), dtype=np.int64)
        least, most = np.full((n_ranges, size), 2 ** 63 - 1, dtype=np.int64), np.full((n_ranges, size), -2 ** 63, dtype=np.int64)
        for values, known in blocks:
            for slot, wanted in by_slot.items():
                own = np.sort(codes(values[slot][known[slot]]))
                for k, low, high, shift in wanted:
                    part = own[np.searchsorted(own, low):np.searchsorted(own, high, side="right")]
                    if not len(part):
                        continue
                    cell = ((part - np.int64(low)).view(np.uint64) >> np.uint64(shift)).astype(np.int64)
                    first = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1])
                    behind = np.append(first[1:], len(cell))
                    hit = cell[first]
                    count[k, hit] += behind - first
                    least[k, hit] = np.minimum(least[k, hit], part[first])
                    most[k, hit] = np.maximum(most[k, hit], part[behind - 1])
        at, cell = np.nonzero(count)
        if len(at):
            yield {"at": at, "cell": cell, "n": count[at, cell], "least": least[at, cell], "most": most[at, cell]}

    merged = (scan(arrays, n, summarise, "at long, cell long, n long, least long, most long", prepare)
              .groupBy("at", "cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))).toArrow()
    at, cell, count, least, most = (merged.column(c).to_numpy() for c in ("at", "cell", "n", "least", "most"))
    order = np.lexsort((cell, at))
    at, count, least, most = at[order], count[order], least[order], most[order]
    starts, stops = np.searchsorted(at, np.arange(n_ranges)), np.searchsorted(at, np.arange(n_ranges), side="right")
    return {r: (count[a:b], least[a:b], most[a:b]) for r, a, b in zip(ranges, starts, stops)}


# --- areas under the curve --------------------------------------------------

def bounds(arrays: DataFrame, n: int, cells: int) -> list[list[int]]:
    """For each position the codes between ``cells`` cells with about equally many of these rows."""
    codes = ordering()
    found = array_quantiles(arrays, n, [i / cells for i in range(1, cells)])
    return [sorted({int(codes(np.array([v]))[0]) for v in values if v is not None}) for values in found]


def moved_areas(rows: DataFrame, label: str, weights: Sequence[float], slots: Sequence[int], cell_bounds: dict[int, Sequence[int]]) -> DataFrame:
    """(_repeat, _slot, roc_auc): the exact area of the margins moved by weight times (donor - own), for each slot.

    ``rows`` are (_repeat, label, _margin, x, donor).  A batch's margins of one
    slot go through the shuffle as two binary values a cell, those of the ones
    and those of the zeros; equal margins meet in one cell.  Ties count half, a
    null is below and a not-a-number above all others; null with one class only.
    """
    weights, codes = np.array(weights, dtype=float), ordering()
    edges = {s: np.array(cell_bounds.get(s, ()), dtype=np.int64) for s in slots}

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            repeat, y, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            margin = margin.astype(float)
            flats = [batch.column(i).flatten() for i in (3, 4)]
            own, other = (np.ascontiguousarray(f.to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1).T) for f in flats)
            unknown = np.zeros(own.shape, dtype=bool)
            for f in flats:
                if f.null_count:
                    unknown |= f.is_null().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            unknown |= batch.column(2).is_null().to_numpy(zero_copy_only=False)[None, :]
            made: dict[str, list] = {"_repeat": [], "_slot": [], "cell": [], "pos": [], "neg": []}
            classes = [(r, np.flatnonzero((repeat == r) & (y == 1)), np.flatnonzero((repeat == r) & (y == 0))) for r in np.unique(repeat)]
            with np.errstate(all="ignore"):
                for s in slots:
                    moved = codes(margin + (other[s] - own[s]) * weights[s])
                    moved[unknown[s]] = -2 ** 63
                    for r, *of in classes:
                        sides = [np.sort(moved[rows]) for rows in of]
                        ends = [[0, *np.searchsorted(side, edges[s]), len(side)] for side in sides]
                        for cell in range(len(edges[s]) + 1):
                            pos, neg = (side[end[cell]:end[cell + 1]] for side, end in zip(sides, ends))
                            if len(pos) or len(neg):
                                for name, value in zip(made, (int(r), s, cell, pos.tobytes(), neg.tobytes())):
                                    made[name].append(value)
            yield pa.RecordBatch.from_pydict(made, pa.schema([("_repeat", pa.int32()), ("_slot", pa.int32()), ("cell", pa.int32()), ("pos", pa.binary()), ("neg", pa.binary())]))

    def merged(table: pa.Table) -> pa.Table:
        pos, neg = (np.sort(np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=np.int64)) for c in ("pos", "neg"))
        area = (np.searchsorted(neg, pos) + np.searchsorted(neg, pos, side="right")).sum() / 2
        return pa.table({**{c: table.column(c).slice(0, 1) for c in ("_repeat", "_slot", "cell")}, "n_pos": [len(pos)], "n_neg": [len(neg)], "area": [float(area)]})

    known = rows.where(F.col("x").isNotNull() & F.col("donor").isNotNull()).select("_repeat", label, "_margin", "x", "donor")
    cells = (known.mapInArrow(parts, "_repeat int, _slot int, cell int, pos binary, neg binary")
             .groupBy("_repeat", "_slot", "cell").applyInArrow(merged, "_repeat int, _slot int, cell int, n_pos long, n_neg long, area double"))
    before = F.coalesce(F.sum("n_neg").over(Window.partitionBy("_repeat", "_slot").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    area = F.try_divide(F.sum(F.col("area") + F.col("n_pos").cast("double") * F.col("before")), F.sum(F.col("n_pos").cast("double")) * F.sum(F.col("n_neg").cast("double")))
    return cells.withColumn("before", before).groupBy("_repeat", "_slot").agg(area.alias("roc_auc"))
