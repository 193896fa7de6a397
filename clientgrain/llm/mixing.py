"""Mixing sources to target weights by nested hash thresholds.

Each document has a fixed hash.  A source that is to give ``rest`` words beyond
whole repeats gives its documents with the lowest hashes.  Where that threshold
lies is found without sorting: words are summed by source and hash cell, the
cell in which the budget runs out is split into finer cells, and so on until it
holds a single hash.  Larger budgets only add documents, so mixes are nested.

Everything is aggregation and equi-join; a source with a third of all documents
sends a few thousand sums through the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_if_small, cut

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
# A hash has 60 bits, read in steps of this many.
STEP_BITS = 12
HASH_BITS = 60


def doc_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id's decimal text, a colon and the text; any engine can compute it.  Null is ''."""
    parts = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, hash): the words of each whole text."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
                       doc_hash(F.col(id_col), F.col(text)).alias("hash"))


def weighted_sources(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """(source, source_size, weight): weights repeat over the sources in code point order, null last.

    Ranks come from range partitions and their counts, so any number of sources will do.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    parted = cut(totals.repartitionByRange(F.col("source").asc_nulls_last())
                 .select("*", F.spark_partition_id().alias("part")))
    counts = sorted((r["part"], r["count"]) for r in parted.groupBy("part").count().collect())
    first, firsts = 0, []
    for part, n in counts:
        firsts.append((part, first))
        first += n
    start = F.coalesce(*[F.when(F.col("part") == p, F.lit(n)) for p, n in firsts]) if firsts else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + start
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    return cut(parted.select("source", "source_size", weight.alias("weight")))


def with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds ``target``: a share by weight of ``share`` times all words, at most ``most`` times the source.

    What a full source cannot take goes to the others by weight.  Each round
    fills at least one more source, and needs two sums over the sources.
    """
    def sums(level: float) -> tuple[int, float, float]:
        full = F.col("weight") * level >= F.col("source_size") * most
        row = sources.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("size"),
                          F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("weight")).first()
        return row["n"], float(row["size"] or 0), float(row["weight"] or 0)

    row = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget, level, before = share * float(row["size"] or 0), 0.0, -1
    if row["weight"]:
        level = budget / float(row["weight"])
        while True:
            n, size, weight = sums(level)
            if n == before or weight == 0:
                break
            before, level = n, (budget - most * size) / weight
    return sources.select("*", F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level)).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, repeats, upto): every document is taken ``repeats`` times, those with hash <= ``upto`` once more."""
    plan = cut(targets.select(
        F.col("source").alias("key"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("repeats"))
        .withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size")))
    # The documents that may lie on the boundary, and the words that come before them.
    few = broadcast_if_small(plan, plan.count())
    inside = sizes.join(few, F.col("source").eqNullSafe(F.col("key"))).where("rest > 0 AND size > 0").select(
        "source", "size", "hash", "rest", F.lit(0).cast("long").alias("before"))
    for done in range(STEP_BITS, HASH_BITS + 1, STEP_BITS):
        cells = (inside.groupBy("source", "rest", "before", F.shiftright("hash", HASH_BITS - done).alias("cell"))
                 .agg(F.sum("size").alias("words"), F.min("hash").alias("least"), F.max("hash").alias("most")))
        by = Window.partitionBy("source").orderBy("cell")
        upto = F.col("before") + F.sum("words").over(by)
        edge = cut(cells.select("source", "rest", "words", "least", "most", "cell", (upto - F.col("words")).alias("start"), upto.alias("stop"))
                   .where("start < rest AND stop >= rest")
                   .select(F.col("source").alias("key"), F.col("cell").alias("edge"), "rest", "words", "least", "most", F.col("start").alias("before")))
        if done == HASH_BITS or edge.where("least < most").isEmpty():
            break
        inside = cut(inside.drop("rest", "before").join(
            broadcast_if_small(edge, edge.count()), F.col("source").eqNullSafe(F.col("key")) & (F.shiftright("hash", HASH_BITS - done) == F.col("edge")))
            .select("source", "size", "hash", "rest", "before"))
    # The hash on the boundary goes in if that brings the source nearer to its target.
    nearer = F.col("before") + F.col("words") - F.col("rest") < F.col("rest") - F.col("before")
    edge = edge.select(F.col("key").alias("source"), F.when(nearer, F.col("most")).otherwise(F.col("least") - 1).alias("upto"))
    return cut(plan.join(edge.withColumnRenamed("source", "at"), F.col("key").eqNullSafe(F.col("at")), "left")
               .select(F.col("key").alias("source"), "source_size", "target", "repeats", F.coalesce("upto", F.lit(-1)).alias("upto")))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """One row for each input row: doc_id, size, source_size, target, copies, taken.

    A null source is a source of its own, the last.  A null or empty text has
    size 0 and takes nothing.  Rows with the same id and text share a hash and
    are taken together; other rows with one id, or without, each have their own.
    Other columns are ignored.  An empty table gives an empty result.
    """
    sizes = cut(sized(docs, id_col, text, source))
    limits = thresholds(sizes, with_targets(weighted_sources(sizes, weights), share, most)).withColumnRenamed("source", "key")
    copies = F.when(F.col("size") > 0, F.col("repeats") + (F.col("hash") <= F.col("upto")).cast("long")).otherwise(0)
    return (sizes.join(broadcast_if_small(limits, limits.count()), F.col("source").eqNullSafe(F.col("key")))
            .select("doc_id", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
               weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, unchanged; texts without words go.

    Repeated rows, null ids, texts and sources as in ``mix``; an empty table stays empty.
    """
    sizes = cut(sized(docs, id_col, text, source))
    limits = (thresholds(sizes, with_targets(weighted_sources(sizes, weights), share, most)).select("source", "repeats", "upto"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).alias("own"),
                       doc_hash(F.col(id_col), F.col(text)).alias("hash"), F.col(text).cast("string").rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    taken = (rows.where("worded").join(broadcast_if_small(limits, limits.count()), F.col("own").eqNullSafe(F.col("source")))
             .withColumn("copies", (F.col("repeats") + (F.col("hash") <= F.col("upto")).cast("long")).cast("int")))
    return (taken.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))


MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15)) AS BIGINT) AS hash
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT a.source, ((SELECT 1.5::DOUBLE * sum(source_size) FROM totals)
          - coalesce((SELECT 2.0::DOUBLE * sum(b.source_size) FROM totals b WHERE b.source_size / b.weight < a.source_size / a.weight), 0))
         / (SELECT sum(b.weight) FROM totals b WHERE b.source_size / b.weight >= a.source_size / a.weight) AS level,
         a.source_size, a.weight
  FROM totals a),
chosen AS (SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE weight * level < 2 * source_size),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM chosen), 1e300)) AS target FROM totals),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM targets),
sums AS (SELECT source, hash, sum(size) AS words FROM sizes WHERE size > 0 GROUP BY source, hash),
running AS (
  SELECT s.source, s.hash, p.target - p.repeats * p.source_size AS rest,
         sum(words) OVER (PARTITION BY s.source ORDER BY hash) AS stop, sum(words) OVER (PARTITION BY s.source ORDER BY hash) - words AS start
  FROM sums s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
upto AS (SELECT source, max(hash) AS upto FROM running
         WHERE rest > 0 AND (stop < rest OR (start < rest AND stop - rest < rest - start)) GROUP BY source)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(CASE WHEN d.size > 0 THEN p.repeats + CAST(d.hash <= coalesce(u.upto, -1) AS BIGINT) ELSE 0 END AS BIGINT) AS copies,
       CAST(d.size * CASE WHEN d.size > 0 THEN p.repeats + CAST(d.hash <= coalesce(u.upto, -1) AS BIGINT) ELSE 0 END AS BIGINT) AS taken
FROM sizes d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN upto u ON d.source IS NOT DISTINCT FROM u.source
"""
