"""Passages that repeat across documents, by banded MinHash of paragraphs.

Paragraphs come in two sizes.  The first is a line with words.  Lines with equal
shingle sets fall together first; the distinct ones are sketched, and bands of
the sketch put similar ones in the same bucket, where they are compared exactly.
Similar lines form clusters; all but the first of a cluster are repeats.  A
repeat is removed if it belongs to a run of neighbouring repeats of at least
``MIN_WORDS`` words: short lines that recur everywhere stay unless they are part
of a longer repeated passage.  The second are the content-defined units of
``passage_units``, which find what is repeated inside lines of different text.
Both come from one reading of the texts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import buckets
from .buckets import MIX, SHINGLE_WORDS, THRESHOLD, Sketcher, components, linked_sets, word_hashes
from .passage_units import UNITS, repeated_passages, stored, units_of, without_spans
from .texts import map_texts

MIN_WORDS = 50
RECALL = 0.999
# Two minima a band need the fewest bands, and so the fewest entries, for the recall.
ROWS = 2
# Smaller sets are similar at the threshold only if they are equal.
LEAST_SHINGLES = 4
WIDTH = 2

PARAGRAPH = T.StructType([
    T.StructField("number", T.IntegerType()), T.StructField("place", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("n_words", T.IntegerType()),
    T.StructField("id", T.BinaryType()), T.StructField("size", T.IntegerType()), T.StructField("sketch", T.BinaryType())])


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands after which a pair at the threshold shares a bucket with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


class Paragraphs:
    """The paragraphs of a text and their shingle sets, all at once."""

    def __init__(self, text: str | None, size: int = SHINGLE_WORDS) -> None:
        lines = text.split("\n") if text else []
        words, counts, self.places = [], [], []
        at = 0
        for number, line in enumerate(lines):
            own = line.encode("utf-8", "surrogatepass").split()
            if own:
                self.places.append((number, len(self.places), at, at + len(line), len(own)))
                counts.append(len(own))
                words += own
            at += len(line) + 1
        if not words:
            self.grams = self.first = self.h = np.zeros(0, dtype=np.int64)
            return
        self.h = h = word_hashes(words)
        count = np.array(counts)
        begin = np.concatenate([[0], np.cumsum(count)[:-1]])
        line = np.repeat(np.arange(len(count)), count)
        # Runs of ``size`` words inside a paragraph; a shorter paragraph is one run.
        runs, owners = [], []
        for words_in_run, starts in [(size, None), *[(c, begin[count == c]) for c in range(1, size) if (count == c).any()]]:
            n = max(0, len(h) - size + 1)
            own = line[:n] if starts is None else line[starts]
            run = np.full(len(own), words_in_run, dtype=np.uint64)
            for i in range(words_in_run):
                run = (run ^ (h[i:i + n] if starts is None else h[starts + i])) * MIX
                run ^= run >> np.uint64(29)
            whole = own == line[size - 1:] if starts is None else slice(None)
            runs.append(run[whole])
            owners.append(own[whole])
        run, owner = np.concatenate(runs), np.concatenate(owners)
        if len(runs) > 1:
            order = np.argsort(owner, kind="stable")
            run, owner = run[order], owner[order]
        first = np.searchsorted(owner, np.arange(len(count)))
        self.grams, self.first, self.owner, self.count = run, first, owner, count
        low = np.sort(run)
        if (low[1:] == low[:-1]).any():
            self.order()

    def order(self) -> None:
        """Puts each set in ascending order, without repeats."""
        if not self.places:
            return
        order = np.lexsort((self.grams, self.owner))
        run, owner = self.grams[order], self.owner[order]
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])])
        self.grams, self.owner = run[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(len(self.count)))

    def ids(self) -> np.ndarray:
        """Two sums over each set, as 16 bytes."""
        one = (self.grams ^ (self.grams >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        two = (self.grams ^ (self.grams >> np.uint64(27))) * np.uint64(0xC2B2AE3D27D4EB4F)
        two ^= two >> np.uint64(32)
        return np.stack([np.add.reduceat(one ^ (one >> np.uint64(32)), self.first), np.add.reduceat(two, self.first)], axis=1)

    def sets(self) -> list[tuple[bytes, np.ndarray]]:
        if not self.places:
            return []
        self.order()
        last = [*self.first[1:].tolist(), len(self.grams)]
        return [(i.tobytes(), self.grams[a:b]) for i, a, b in zip(self.ids(), self.first.tolist(), last)]

    def rows(self, sketch: Sketcher) -> list[tuple]:
        if not self.places:
            return []
        size = np.diff(np.concatenate([self.first, [len(self.grams)]]))
        x = (self.grams >> np.uint64(32)).astype(np.uint32)
        low = np.empty((len(size), len(sketch.a)), dtype=np.uint32)
        for i, (a, b) in enumerate(zip(sketch.a, sketch.b)):
            low[:, i] = np.minimum.reduceat(x * a + b, self.first)
        low = (low * np.uint32(0x85EBCA6B) ^ (low >> np.uint32(13))).astype(sketch.dtype)
        return [(*place, i.tobytes(), int(n), m.tobytes() if n >= LEAST_SHINGLES else None)
                for place, i, n, m in zip(self.places, self.ids(), size, low)]


def read_texts(docs: DataFrame, positions: int, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, paragraphs, units' columns) of (doc_id, text_key, text): all that the search needs, from one reading."""
    schema = T.StructType([T.StructField("paragraphs", T.ArrayType(PARAGRAPH)), *UNITS.fields])

    def make():
        sketch = Sketcher(positions, "<u2")

        def both(text):
            own = Paragraphs(text, size)
            return (own.rows(sketch), *units_of((text or "").encode("utf-8", "surrogatepass"), own.h))
        return lambda columns: map(both, columns[0])

    return map_texts(docs, ["doc_id", "text_key"], ["text"], schema, make)


def clusters(docs: DataFrame, found: DataFrame, bands: int, threshold: float, size: int) -> DataFrame:
    """(id, cluster) of every paragraph that occurs or resembles more than once."""
    classes = stored(found.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times"),
                                          F.first("size").alias("size"), F.first("sketch").alias("sketch")))
    items = classes.where("sketch IS NOT NULL").select("id", "size", F.lit(1).cast("long").alias("copies"), "sketch")
    band = [F.xxhash64(F.lit(b), F.substring("sketch", b * ROWS * WIDTH + 1, ROWS * WIDTH)) for b in range(bands)]
    entries = items.select("id", F.explode(F.array(*band)).alias("key"))

    def sets(ids: DataFrame) -> DataFrame:
        return buckets.gram_sets(docs, ids.join(classes.select("id", "doc_id"), "id"), lambda: lambda text: Paragraphs(text, size).sets())

    alike = components(linked_sets(items, entries, sets, threshold, bands * ROWS, "<u2"))
    return (classes.join(alike, "id", "left").where("times > 1 OR component IS NOT NULL")
            .select("id", F.coalesce("component", "id").alias("cluster")))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, text) of the rows with an id and a text; text_key is the text's xxhash64."""
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
            .where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("text_key", F.xxhash64("text")))


def repeated_lines(slim: DataFrame, read: DataFrame, threshold: float, size: int, min_words: int, bands: int) -> DataFrame:
    """(doc_id, text_key, paragraph, start, end, n_words, first_doc_id, first_paragraph) of the lines to remove."""
    found = read.select("doc_id", "text_key", F.explode("paragraphs").alias("p")).select("doc_id", "text_key", "p.*")
    groups = clusters(slim, found.drop("text_key", "place", "start", "end", "n_words"), bands, threshold, size)
    again = stored(found.drop("sketch", "size").join(groups, "id").drop("id"))
    firsts = again.groupBy("cluster").agg(F.min(F.struct("doc_id", "number")).alias("first"))
    repeats = (again.join(firsts, "cluster").where("struct(doc_id, number) != first").drop("cluster")
               .dropDuplicates(["doc_id", "text_key", "number"]))
    by_text = Window.partitionBy("doc_id", "text_key")
    runs = repeats.withColumn("run", F.col("place") - F.row_number().over(by_text.orderBy("place")))
    together = F.sum("n_words").over(Window.partitionBy("doc_id", "text_key", "run"))
    return (runs.withColumn("together", together).where(F.col("together") >= min_words)
            .select("doc_id", "text_key", F.col("number").alias("paragraph"), "start", "end", "n_words",
                    F.col("first.doc_id").alias("first_doc_id"), F.col("first.number").alias("first_paragraph")))


def repeated_paragraphs(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE_WORDS, min_words: int = MIN_WORDS,
                        recall: float = RECALL, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each line to remove: doc_id, paragraph (line number from 0),
    start and end (code points), n_words, first_doc_id and first_paragraph (where the passage stays).

    Of a cluster of similar lines the first by (doc_id, line) stays.
    Repeated input rows count as one document.  Rows with a null id or text,
    and texts without words, have nothing to remove.  Other columns are ignored.
    An empty table gives an empty result.
    """
    slim, bands = keyed_texts(docs, id_col, text), bands_for(threshold, recall)
    read = stored(read_texts(slim, bands * ROWS, size).drop(*UNITS.names))
    return repeated_lines(slim, read, threshold, size, min_words, bands).drop("text_key")


def removals(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE_WORDS, min_words: int = MIN_WORDS,
             recall: float = RECALL, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each line and each passage inside lines to remove: doc_id, text_key (xxhash64 of the text), paragraph
    (line number from 0, null for a passage), start and end (code points), n_words, first_doc_id and first_paragraph.

    What a cluster of similar lines, or a run of equal words, has first by
    (doc_id, place) stays.  A line and a passage may name the same words.
    An id with several texts is a document for each.  Otherwise as
    ``repeated_paragraphs``.
    """
    slim, bands = keyed_texts(docs, id_col, text), bands_for(threshold, recall)
    read = stored(read_texts(slim, bands * ROWS, size))
    lines = repeated_lines(slim, read.drop(*UNITS.names), threshold, size, min_words, bands)
    names = UNITS.names
    units = (read.select("doc_id", "text_key", F.explode(F.arrays_zip(*names)).alias("u"))
             .select("doc_id", "text_key", F.col("u.hashes").alias("hash"), *[F.col(f"u.{c}").alias(c) for c in names[1:]]))
    passages = repeated_passages(slim, units, min_words)
    return lines.unionByName(passages.withColumns({c: F.lit(None).cast("int") for c in ("paragraph", "first_paragraph")}))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines and passages of ``removals`` cut out of ``text`` and ``n_chars`` adjusted.

    A line goes with its line end.  Documents of which no word is left go; so do
    those that had none.  Rows without an id keep their text.  Repeated rows are
    cut alike and all stay.  An empty table stays empty.
    """
    gone = removals(docs).select("doc_id", "text_key", "start", (F.col("end") + F.col("paragraph").isNotNull().cast("long")).alias("end"))
    cleaned = without_spans(docs, gone)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
