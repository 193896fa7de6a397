"""Documents that share most of their word shingles, by chosen-path splitting.

Each set of shingles is represented by the minima of a few random permutations.
A run starts with all sets in one bucket and splits it by the values at two
sampled positions; buckets that stay large are split again at positions of their
own.  Small buckets are compared set by set, exactly.  Similar sets agree at
most positions, so they follow each other down at least one branch with high
probability; as many runs are made as the wanted recall asks for.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, cut
from . import buckets
from .buckets import BLOCK, SHINGLE_WORDS, THRESHOLD, Sketcher, components, digest, linked_sets, path_key, shingles
from .texts import map_texts, words_of

RECALL = 0.9999
POSITIONS = 64
WIDTH = 4
BRANCHES = 2
# Buckets that are still large after so many splits are compared in tiles.
DEPTH = 3
# So are buckets of which a split leaves at least this share together: their sets
# are alike, and splitting them again would only repeat them.
DENSE = 0.5

FACTS = T.StructType([T.StructField("id", T.BinaryType()), T.StructField("size", T.IntegerType()), T.StructField("sketch", T.BinaryType())])


def runs_for(recall: float, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold shares a last bucket with probability ``recall``."""
    found = 1.0
    for _ in range(depth):
        found = 1 - (1 - threshold * found) ** BRANCHES
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, id, size, sketch): ``id`` is a digest of the shingle set, null for a text without words."""
    def make():
        sketch = Sketcher(POSITIONS, "<u4")

        def facts(text):
            grams = shingles(words_of(text), size)
            return (digest(grams), len(grams), sketch(grams)) if len(grams) else (None, 0, None)
        return lambda columns: map(facts, columns[0])

    return map_texts(docs, ["doc_id"], ["text"], FACTS, make)


def chosen_paths(items: DataFrame, runs: int) -> DataFrame:
    """The distinct (id, key) of the buckets at the ends of all paths."""
    sketches = items.select("id", "sketch")
    large = (sketches.withColumn("path", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))))
             .withColumn("of", F.lit(None).cast("long")))
    ends = []
    for depth in range(1, DEPTH + 1):
        at = [F.pmod(F.xxhash64("path", F.lit(b)), F.lit(POSITIONS)).cast("int") for b in range(BRANCHES)]
        children = F.array_distinct(F.array(*[path_key(F.col("path"), p, F.col("sketch"), WIDTH) for p in at]))
        split = cut(large.select("id", "path", "of", F.explode(children).alias("key")))
        counts = cut(split.groupBy("key").agg(F.count("*").alias("n"), F.first("path").alias("path"), F.first("of").alias("of")).where("n > 1"))
        dense = cut(counts.where(F.col("n") >= F.col("of") * DENSE).select("path").distinct())
        n_dense = dense.count()
        if n_dense:
            ends.append(split.join(broadcast_if_small(dense, n_dense), "path").select("id", F.col("path").alias("key")).distinct())
            counts = cut(counts.join(broadcast_if_small(dense, n_dense), "path", "left_anti"))
        last = depth == DEPTH
        ends.append(split.select("id", "key").join((counts if last else counts.where(F.col("n") <= BLOCK)).select("key"), "key").select("id", "key"))
        more = counts.where(F.col("n") > BLOCK)
        if last or more.isEmpty():
            break
        large = (split.select("id", "key").join(more.select("key", F.col("n").alias("of")), "key").join(sketches, "id")
                 .select("id", "sketch", F.col("key").alias("path"), "of"))
    return reduce(DataFrame.unionByName, ends)


def ngram_join(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE_WORDS, recall: float = RECALL,
               id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, class_id, n_links, same_set_id.

    ``n_links`` counts the other documents whose shingle set has a Jaccard
    similarity of at least ``threshold``; ``class_id`` is the smallest doc_id
    reachable over links and ``same_set_id`` the smallest with an equal set.
    Texts of fewer than ``size`` words are one shingle; texts without words
    (null, empty) link with nothing.  Repeated rows count as one document; an
    id with several texts is a document for each.  Rows without id come out
    once for each text, unlinked, with null ids.  Other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    facts = cut(sketched(slim, size))
    linkable = facts.where("id IS NOT NULL AND doc_id IS NOT NULL")
    classes = cut(linkable.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count_distinct("doc_id").alias("copies"),
                                             F.first("size").alias("size"), F.first("sketch").alias("sketch")))

    def sets(ids: DataFrame) -> DataFrame:
        def of_text():
            def one(value):
                grams = shingles(words_of(value), size)
                return [(digest(grams), grams)]
            return one
        return buckets.gram_sets(slim, ids.join(classes.select("id", "doc_id"), "id"), of_text)

    links = linked_sets(classes, chosen_paths(classes, runs_for(recall, threshold)), sets, threshold, POSITIONS)
    counted = links.groupBy("id").agg(F.sum("linked").alias("linked"))
    reach = components(links)
    lowest = (reach.join(classes.select("id", "doc_id"), "id").groupBy("component").agg(F.min("doc_id").alias("least")))
    of_class = (classes.select("id", "doc_id", "copies").join(counted, "id", "left").join(reach, "id", "left").join(lowest, "component", "left")
                .select("id", F.col("doc_id").alias("same_set_id"), F.coalesce("least", "doc_id").alias("class_id"),
                        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    rows = facts.select("doc_id", "id").distinct()
    has = F.col("doc_id").isNotNull()
    return (rows.join(of_class, "id", "left")
            .select("doc_id", F.when(has, F.coalesce("class_id", "doc_id")).alias("class_id"),
                    F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
                    F.when(has, F.coalesce("same_set_id", "doc_id")).alias("same_set_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class, and those without an id.

    Repeated rows stay once.
    """
    found = cut(ngram_join(docs, id_col=id_col, text=text).where("doc_id IS NOT NULL").select("doc_id", "class_id"))
    per_id = found.groupBy("doc_id").agg(F.bool_and(F.col("class_id") != F.col("doc_id")).alias("goes"))
    goes = cut(per_id.where("goes").select(F.col("doc_id").alias("__gone")))
    kept = docs.join(broadcast_if_small(goes, goes.count()), F.col(id_col) == F.col("__gone"), "left_anti")
    again = cut(docs.groupBy(F.col(id_col).alias("__again")).count().where("count > 1 AND __again IS NOT NULL").select("__again"))
    if again.isEmpty():
        return kept
    several = broadcast_if_small(again, again.count())
    return (kept.join(several, F.col(id_col) == F.col("__again"), "left_anti")
            .unionByName(kept.join(several, F.col(id_col) == F.col("__again"), "left_semi").dropDuplicates()))
