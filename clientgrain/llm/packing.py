"""Packing documents into sequences by cutting-stock column generation.

Documents are cut into full sequences and one remainder each.  Remainders are
counted by length class; a linear program over patterns (how many remainders of
each class fill a sequence) is solved by column generation, with a knapsack
recursion that prices new patterns.  It sees only the histogram, so its size
does not depend on the number of documents.  The rounded patterns are then
assigned by rank: the k-th remainder of a class belongs to a known sequence.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut
from .texts import map_texts
from .tokens import ID_BYTES, encoder

LENGTH = 2048
# Remainders are rounded up to this many tokens, which bounds the linear program
# at LENGTH / UNIT rows and wastes UNIT / 2 tokens a remainder.
UNIT = 16
# Ranks are counted in this many slices of each class (more for large inputs),
# so that a length many documents share is not ranked by one task.
SLICES = 64
SLICE_ROWS = 50_000
# Rounds of the linear program without progress before it ends.
PATIENCE = 10

PIECE = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("ids_crc32", T.LongType())])
CUT = T.StructType([T.StructField("doc_tokens", T.LongType()), T.StructField("pieces", T.ArrayType(PIECE))])


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, id_col: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """(doc_id, doc_tokens, start, length, ids_crc32): each document's full sequences and its remainder."""
    end = end_id.to_bytes(ID_BYTES, "little")
    step = length * ID_BYTES

    def make():
        encode = encoder(tokenizer)

        def rows(columns):
            for ids in encode(columns[0]):
                ids += end
                yield len(ids) // ID_BYTES, [
                    (at // ID_BYTES, min(step, len(ids) - at) // ID_BYTES, zlib.crc32(ids[at:at + step]))
                    for at in range(0, len(ids), step)]
        return rows

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return (map_texts(slim, ["doc_id"], ["text"], CUT, make)
            .select("doc_id", "doc_tokens", F.explode("pieces").alias("p")).select("doc_id", "doc_tokens", "p.*"))


def best_patterns(values: np.ndarray, sizes: np.ndarray, room: int) -> list[tuple[float, Counter]]:
    """For each size the most valuable multiset that holds it and fits, best first.

    One unbounded knapsack recursion over the room answers for all sizes.
    """
    worth = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for space in range(int(sizes[0]), room + 1):
        fits = np.searchsorted(sizes, space, side="right")
        total = worth[space - sizes[:fits]] + values[:fits]
        best = int(np.argmax(total))
        if total[best] > worth[space - 1] + 1e-12:
            worth[space], choice[space] = total[best], best
        else:
            worth[space] = worth[space - 1]

    def filled(first: int) -> Counter:
        pattern, space = Counter({first: 1}), room - int(sizes[first])
        while space > 0:
            if choice[space] < 0:
                space -= 1
            else:
                pattern[int(choice[space])] += 1
                space -= int(sizes[choice[space]])
        return pattern

    total = values + worth[room - sizes]
    return [(float(total[i]), filled(int(i))) for i in np.argsort(-total) if total[i] > 1]


def fractional_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, tolerance: float = 1e-3) -> list[tuple[Counter, float]]:
    """Patterns and how often each is used, fewest sequences in all.

    Revised simplex; columns are made as the prices ask for them.  It ends when
    no pattern is worth more than ``1 + tolerance`` sequences, which bounds the
    distance from the optimum by the same factor, or when ``PATIENCE`` rounds
    brought next to nothing.
    """
    m = len(sizes)
    patterns = [Counter({i: int(room // s)}) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / p[i] for i, p in enumerate(patterns)])
    used = inverse @ demand
    totals: list[float] = []
    while True:
        totals.append(float(used.sum()))
        if len(totals) > PATIENCE and totals[-1] > totals[-1 - PATIENCE] * (1 - tolerance / 10):
            break
        offered = best_patterns(inverse.sum(axis=0), sizes, room)
        if not offered or offered[0][0] <= 1 + tolerance:
            break
        for _, pattern in offered:
            column = np.zeros(m)
            column[list(pattern)] = list(pattern.values())
            direction = inverse @ column
            # Its worth at today's prices; earlier columns of this round changed them.
            if direction.sum() <= 1 + tolerance / 2:
                continue
            rising = direction > 1e-9
            if not rising.any():
                continue
            steps = np.full(m, np.inf)
            steps[rising] = used[rising] / direction[rising]
            leave = int(np.argmin(steps))
            step = max(0.0, float(steps[leave]))
            used = used - step * direction
            used[leave] = step
            pivot = inverse[leave] / direction[leave]
            inverse = inverse - np.outer(direction, pivot)
            inverse[leave] = pivot
            patterns[leave] = pattern
    return [(p, max(0.0, float(u))) for p, u in zip(patterns, used)]


def rounded_patterns(sizes: list[int], demand: list[int], room: int) -> list[tuple[Counter, int]]:
    """(pattern by size, sequences) that hold the demand exactly.

    Uses are rounded down; what is left (a few sequences' worth for each
    pattern, whatever the input) is placed best fit, largest first.
    """
    if not sizes:
        return []
    sizes_a, left = np.array(sizes), np.array(demand, dtype=np.int64)
    plan: list[tuple[Counter, int]] = []
    for pattern, used in fractional_patterns(sizes_a, left.astype(float), room):
        times = int(used + 1e-6)
        times = min([times, *[int(left[i]) // n for i, n in pattern.items()]])
        if times > 0:
            plan.append((Counter({sizes[i]: n for i, n in pattern.items()}), times))
            for i, n in pattern.items():
                left[i] -= n * times
    open_by_room: dict[int, list[Counter]] = {}
    for i in np.argsort(-sizes_a):
        size = sizes[i]
        for _ in range(int(left[i])):
            space = min((r for r, held in open_by_room.items() if r >= size and held), default=None)
            held = open_by_room[space].pop() if space is not None else Counter()
            space = room if space is None else space
            held[size] += 1
            open_by_room.setdefault(space - size, []).append(held)
    leftover = Counter(tuple(sorted(h.items())) for held in open_by_room.values() for h in held)
    return plan + [(Counter(dict(k)), n) for k, n in sorted(leftover.items())]


def places(plan: list[tuple[Counter, int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, last rank, items in each sequence, first sequence) for each pattern and class."""
    rank: Counter = Counter()
    out, sequence = [], 0
    for pattern, times in plan:
        for size, n in sorted(pattern.items()):
            out.append((size, rank[size], rank[size] + n * times - 1, n, sequence))
            rank[size] += n * times
        sequence += times
    return out


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank``, from 0 in each class, counted in hash slices of the class."""
    slices = max(SLICES, rows // SLICE_ROWS)
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)).cast("int"))
    counts = sliced.groupBy("class", "slice").agg(F.count("*").alias("n"))
    firsts = counts.select(F.col("class").alias("of"), F.col("slice").alias("at"),
                           (F.sum("n").over(Window.partitionBy("class").orderBy("slice")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("class", "slice").orderBy("doc_id", "start", "length", "ids_crc32")) - 1
    return (sliced.withColumn("within", within).join(firsts, (F.col("class") == F.col("of")) & (F.col("slice") == F.col("at")))
            .withColumn("rank", F.col("before") + F.col("within")))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, with the end id, lies in exactly one piece; the
    pieces of a sequence lie one after the other from offset 0.  A null or empty
    text is its end id alone.  Repeated rows are packed as often as they come.
    Other columns are ignored.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = cut(cut_documents(docs, tokenizer, end_id, length, id_col, text)
                 .withColumn("class", F.ceil(F.col("length") / UNIT).cast("int")))
    counted = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    room = length // UNIT
    sizes = sorted(counted)
    # A class that fills a sequence alone needs no program.
    plan = rounded_patterns([s for s in sizes if s < room], [counted[s] for s in sizes if s < room], room)
    plan += [(Counter({s: 1}), counted[s]) for s in sizes if s >= room]
    # At most as many rows as the program has classes and patterns.
    table = spark.createDataFrame(places(plan), "of_class int, low long, high long, each long, first long")
    placed = (ranked(pieces, sum(counted.values()))
              .join(F.broadcast(table), (F.col("class") == F.col("of_class")) & F.col("rank").between(F.col("low"), F.col("high")))
              .withColumn("sequence_id", F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "rank", "class")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"))
