"""Passages of equal words that stand in different surroundings, by content-defined units.

A text is cut before a word wherever a hash of that word and the one before it
says so, whatever line ends or words stand around; where a few words recur over and
over, the hashes say so everywhere or nowhere, and it is cut every ``LEAST_WORDS`` words
from where that begins.  A unit begins at a cut and goes on to the first cut at least
``LEAST_WORDS`` words later.  Units are so
short that one changed word leaves them below the similarity asked for, so their
band is their whole content.  Units that recur are laid on the first place of
their content; neighbours with the same shift make a run of equal words.  Runs of
``MIN_WORDS`` words are passages.  Around shorter runs, which a passage may go
beyond on both sides, the windows of ``MIN_WORDS`` words are compared as wholes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import broadcast_if_small, cut, scratch_path
from .buckets import MIX, mixed, run_hashes, word_hashes
from .texts import free_name, small_batches

MIN_WORDS = 50
# One word in so many begins a piece.
EVERY = 8
LEAST_WORDS = 12
# Up to so many words are seen to recur over and over.
PERIOD = 8
# How many words a whole passage is looked at beyond its first and last unit.
EDGES = (0, 1, 2, 3, 4, 6, 8, 11, 15, 20, 26)
UNITS = T.StructType([T.StructField("hashes", T.ArrayType(T.LongType())), *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("at", "n", "start", "end")]])


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: a third of what a checkpoint takes."""
    path = scratch_path(df.sparkSession, "passages")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of UTF-8 bytes starts and ends, in code points."""
    raw = np.frombuffer(data, dtype=np.uint8)
    word = np.concatenate([[False], ~((raw == 32) | ((raw >= 9) & (raw <= 13))), [False]])
    edge = np.nonzero(word[1:] != word[:-1])[0]
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return points[edge[::2]], points[edge[1::2]]


def cuts_of(h: np.ndarray) -> np.ndarray:
    """The words, by their hashes, before which a text is cut."""
    pair = mixed(h[:-1]) ^ h[1:]
    over = np.zeros(len(pair), dtype=bool)
    for p in range(1, min(PERIOD, (len(pair) - 1) // 2) + 1):
        same = pair[p:] == pair[:-p]
        over[2 * p:] |= same[p:] & same[:-p]
    hashed = pair * MIX >> np.uint64(40) < np.uint64(2 ** 24 // EVERY)
    if over.any():
        at = np.arange(len(over))
        begins = over & ~np.concatenate([[False], over[:-1]])
        since = at - np.maximum.accumulate(np.where(begins, at, 0))
        hashed = np.where(over, since % LEAST_WORDS == 0, hashed)
    return np.nonzero(hashed)[0] + 1


def units_of(data: bytes, h: np.ndarray) -> tuple:
    """(hash, first word, words, start, end) of each unit, as lists."""
    none = np.zeros(0, dtype=np.int32)
    if len(h) <= LEAST_WORDS:
        return np.zeros(0, dtype=np.int64), none, none, none, none
    cuts = cuts_of(h)
    end = np.searchsorted(cuts, cuts + LEAST_WORDS)
    first, stop = cuts[end < len(cuts)], cuts[end[end < len(cuts)]]
    begins, ends = word_places(data)
    return (run_hashes(mixed(h), first, stop).view(np.int64), first.astype(np.int32), (stop - first).astype(np.int32),
            begins[first].astype(np.int32), ends[stop - 1].astype(np.int32))


def windows_at(text: str, ranges: list, size: int) -> list[np.ndarray]:
    """(hash, first word, start, end) of the windows that begin in one of the ranges."""
    data = text.encode("utf-8", "surrogatepass")
    h = word_hashes(data.split())
    last = len(h) - size
    wanted = np.zeros(max(0, last + 1), dtype=bool)
    for low, high in ranges:
        wanted[max(0, low):max(0, high + 1)] = True
    first = np.nonzero(wanted)[0]
    begins, ends = word_places(data)
    return [run_hashes(mixed(h), first, first + size).view(np.int64), *[c.astype(np.int32) for c in (first, begins[first], ends[first + size - 1])]]


def place() -> Column:
    return F.struct("doc_id", "text_key", "at")


def windows(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, h, at, start, end) of (doc_id, text_key, text, ranges)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [windows_at(t, [(r["low"], r["high"]) for r in ranges], size) for t, ranges in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            if made:
                own = pa.array(np.concatenate([np.full(len(m[0]), i) for i, m in enumerate(made)]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), *[pa.array(np.concatenate(c)) for c in zip(*made)]],
                                                 names=["doc_id", "text_key", "h", "at", "start", "end"])

    small_batches(texts.sparkSession)
    return (texts.select("doc_id", "text_key", "text", "ranges")
            .mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, text_key long, h long, at int, start int, end int"))


def runs_of(units: DataFrame) -> DataFrame:
    """Runs of units (doc_id, text_key, at, n, start, end, hash) that follow an earlier place with one shift.

    (doc_id, text_key, first_doc, first_key, shift, at, stop, start, end, low, high);
    the windows that hold a unit of the run begin from low to high.
    """
    often = cut(units.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash"))
    again = stored(units.join(broadcast_if_small(often, often.count()), "hash"))
    firsts = cut(again.groupBy("hash").agg(F.min(place()).alias("first")))
    laid = (again.join(broadcast_if_small(firsts, firsts.count()), "hash").where(place() != F.col("first"))
            .select("doc_id", "text_key", "at", "n", "start", "end", F.col("first.doc_id").alias("first_doc"), F.col("first.text_key").alias("first_key"),
                    (F.col("at") - F.col("first.at")).alias("shift")))
    aligned = ["doc_id", "text_key", "first_doc", "first_key", "shift"]
    by = Window.partitionBy(*aligned).orderBy("at")
    before = F.max(F.col("at") + F.col("n")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    parted = laid.withColumn("new", (before.isNull() | (F.col("at") > before)).cast("int"))
    return (parted.withColumn("run", F.sum("new").over(by)).groupBy(*aligned, "run")
            .agg(F.min("at").alias("at"), F.max(F.col("at") + F.col("n")).alias("stop"), F.min("start").alias("start"), F.max("end").alias("end"),
                 F.min(F.col("at") + F.col("n")).alias("least_stop"), F.max("at").alias("high")).drop("run"))


def repeated_passages(texts: DataFrame, units: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each stretch of text to remove: doc_id, text_key, start, end (code points), n_words, first_doc_id.

    ``texts`` has (doc_id, text_key, text), ``units`` their units.  A passage stays
    where it stands first by (doc_id, text_key, word); its other occurrences are
    removed, but not one that overlaps the first in the same text.  Touching
    stretches are one.
    """
    runs = stored(runs_of(units))
    own = (F.col("doc_id") == F.col("first_doc")) & (F.col("text_key") == F.col("first_key"))
    n_words = F.col("stop") - F.col("at")
    whole = (n_words >= min_words) & ~(own & (F.col("shift") < n_words))
    # Windows that hold a unit of a short run, and those that reach beyond the ends of a whole passage.
    inside = F.array(F.struct((F.col("least_stop") - min_words).alias("low"), F.col("high").alias("high")))
    ends = F.array(*[F.struct(at.alias("low"), at.alias("high")) for e in EDGES for at in (F.col("at") - e, F.col("stop") - min_words + e)])
    sought = runs.select("*", F.explode(F.when(whole, ends).otherwise(inside)).alias("r"))
    around = (sought.select("doc_id", "text_key", "r.low", "r.high")
              .unionByName(sought.select(F.col("first_doc").alias("doc_id"), F.col("first_key").alias("text_key"),
                                         (F.col("r.low") - F.col("shift")).alias("low"), (F.col("r.high") - F.col("shift")).alias("high"))))
    ranges = cut(around.distinct().groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    single = stored(windows(texts.join(broadcast_if_small(ranges, ranges.count()), ["doc_id", "text_key"]), min_words))
    firsts = cut(single.groupBy("h").agg(F.min(place()).alias("first"), F.count("*").alias("times")).where("times > 1").select("h", "first"))
    same = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    again = (single.join(broadcast_if_small(firsts, firsts.count()), "h")
             .where((place() != F.col("first")) & (~same | (F.col("at") >= F.col("first.at") + min_words))))
    every = (again.select("doc_id", "text_key", "at", (F.col("at") + min_words).alias("stop"), "start", "end", F.col("first.doc_id").alias("first_doc_id"))
             .unionByName(runs.where(whole).select("doc_id", "text_key", "at", "stop", "start", "end", F.col("first_doc").alias("first_doc_id"))))
    by = Window.partitionBy("doc_id", "text_key").orderBy("at", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    parted = every.withColumn("new", (before.isNull() | (F.col("at") > before)).cast("int"))
    return (parted.withColumn("stretch", F.sum("new").over(by)).groupBy("doc_id", "text_key", "stretch")
            .agg(F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"), (F.max("stop") - F.min("at")).cast("int").alias("n_words"),
                 F.min_by("first_doc_id", "at").alias("first_doc_id")).drop("stretch"))


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the (doc_id, text_key, start, end) cut out of ``text``; spans may overlap."""
    found, key, of = (free_name(docs, n) for n in ("spans", "key", "of"))
    by = Window.partitionBy("doc_id", "text_key").orderBy("start", "end")
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    parted = spans.withColumn("new", (before.isNull() | (F.col("start") > before)).cast("int")).withColumn("part", F.sum("new").over(by))
    joined = parted.groupBy("doc_id", "text_key", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    gone = cut(joined.groupBy(F.col("doc_id").alias(key), F.col("text_key").alias(of)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(found)))
    rows = docs.join(broadcast_if_small(gone, gone.count()), (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(of)), "left")
    # What stands before each span, then what stands behind the last.
    last = lambda i: F.when(i == 0, 0).otherwise(F.get(F.col(found), i - 1)["end"])
    pieces = F.transform(found, lambda s, i: F.substring(F.col("text"), last(i).cast("int") + 1, (s["start"] - last(i)).cast("int")))
    behind = F.substring(F.col("text"), F.element_at(found, -1)["end"].cast("int") + 1, F.length("text"))
    kept = F.concat(F.array_join(pieces, ""), behind)
    return rows.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
