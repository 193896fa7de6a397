"""A Merkle manifest of a table: one tree for each group, and a tree over the groups' roots.

Nodes are SHA-256 digests as 64 hex characters.  The nodes of a level that lie in
one aligned block of ``2 ** BLOCK_LEVELS`` are kept as one string.  Fixed-width
substrings of two digests hash to the parents, which make the string of the next
level; the substrings beside a node are its siblings.  The roots of the blocks are
the nodes of the next tier, which is built alike, until a group has one block.
On the way back each block hands what it got from above to its nodes, so the leaves
go through a shuffle by order and one by block, and no other.

Only SQL functions; no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_if_small, cut

NODE = 64
BLOCK_LEVELS = 8
TAMPER_EVERY = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def upto(n: Column) -> Column:
    """0 to n - 1, nothing for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def bits_at(place: Column, level: Column) -> Column:
    return F.call_function("shiftright", place, level)


def piece(level: Column, first: Column, nodes: int) -> Column:
    """Digests ``first`` and following of a level; the empty text behind its end."""
    return F.substring(level.cast("binary"), (first * NODE + 1).cast("int"), F.lit(NODE * nodes)).cast("string")


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``place`` (from 0 by ``order`` in the group ``g``, null first) and ``n``, the rows of the group.

    Rows are dealt into ranges and sorted there; a range's part of a group goes
    on where the ranges before it end.  Equal rows are dealt out, too.
    """
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("g"), *[F.col(c).asc_nulls_first() for c in order], F.col("tie")]
    placed = cut(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
                 .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))
    parts = placed.groupBy("g", "part").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    by = Window.partitionBy("g")
    before = F.sum("here").over(by.orderBy("part")) - F.col("here")
    parts = cut(parts.select("g", "part", "first", before.alias("before"), F.sum("here").over(by).alias("n")))
    return (placed.join(broadcast_if_small(parts, parts.count()), ["g", "part"])
            .withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before"))


def tier(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(g, block, n, items, folds, levels) of nodes (g, place, n, node, *carry): each block's levels, the last its root."""
    blocks = (nodes.groupBy("g", F.shiftright("place", BLOCK_LEVELS).alias("block"))
              .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "node", *carry))).alias("items")))
    # A group of n nodes has as many levels above them as n - 1 has binary digits.
    height = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    blocks = blocks.withColumn("folds", F.least(F.lit(BLOCK_LEVELS), height).cast("int"))

    def above(levels: Column, _: Column) -> Column:
        level = F.element_at(levels, -1)
        parents = F.transform(upto(F.ceil(F.length(level) / (2 * NODE))), lambda i: F.sha2(piece(level, i * 2, 2), 256))
        return F.concat(levels, F.array(F.array_join(parents, "")))

    leaves = F.array_join(F.transform("items", lambda x: x["node"]), "")
    return cut(blocks.withColumn("levels", F.aggregate(upto(F.col("folds")), F.array(leaves), above)))


def sibling(levels: Column, place: Column, level: Column) -> Column:
    """The other digest of the node's run, blanks if it is alone."""
    own = bits_at(place.bitwiseAND(F.lit(2 ** BLOCK_LEVELS - 1)), level)
    return F.rpad(piece(F.get(levels, level), own.bitwiseXOR(F.lit(1)), 1), NODE, " ")


def opened(blocks: DataFrame, handed: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """(g, place, node, segment, *handed, *carry): the nodes of blocks that know the segment ``above`` them."""
    items = blocks.select("g", "levels", "folds", "above", *handed, F.explode("items").alias("item"))
    place = F.col("item.place")
    beside = F.array_join(F.transform(upto(F.col("folds")), lambda k: sibling(F.col("levels"), place, k)), "")
    return items.select("g", place.alias("place"), F.col("item.node").alias("node"), F.concat(beside, "above").alias("segment"),
                        *handed, *[F.col(f"item.{c}").alias(c) for c in carry])


def trees(nodes: DataFrame, carry: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The tiers over nodes (g, place, n, node, *carry), and (g, root) of each group."""
    tiers = [tier(nodes, carry)]
    while not tiers[-1].where(F.col("n") > 2 ** BLOCK_LEVELS).isEmpty():
        roots = tiers[-1].select("g", F.col("block").alias("place"), F.ceil(F.col("n") / 2 ** BLOCK_LEVELS).cast("long").alias("n"),
                                 F.element_at("levels", -1).alias("node"))
        tiers.append(tier(roots))
    return tiers, cut(tiers[-1].select("g", F.element_at("levels", -1).alias("root")))


def segments(tiers: list[DataFrame], roots: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(g, place, node, segment, *columns of roots, *carry) of the first tier's nodes."""
    handed = [c for c in roots.columns if c != "g"]
    blocks = tiers[-1].join(broadcast_if_small(roots, roots.count()), "g").withColumn("above", F.lit(""))
    for lower in reversed(tiers[:-1]):
        paths = cut(opened(blocks, handed).select("g", F.col("place").alias("block"), F.col("segment").alias("above"), *handed))
        blocks = lower.join(broadcast_if_small(paths, paths.count()), ["g", "block"])
    return opened(blocks, handed, carry)


def folded(node: Column, place: Column, segment: Column) -> Column:
    """The root that a node and its siblings lead to."""
    def step(now: Column, k: Column) -> Column:
        other = F.rtrim(piece(segment, k, 1))
        return F.sha2(F.when(bits_at(place, k).bitwiseAND(F.lit(1)) == 1, F.concat(other, now)).otherwise(F.concat(now, other)), 256)
    return F.aggregate(upto(F.length(segment) / NODE), node, step)


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group: str = "lang",
             extra: dict[str, Column] | None = None) -> DataFrame:
    """One row for each input row: doc_id, leaf, place, segment, subroot, group_place, group_segment, root, and ``extra``.

    Leaves of a group ascend by id, null first; rows of one id by their digest,
    so repeated rows lie beside each other.  A null group is a group, the first.
    ``segment`` holds the siblings from leaf to subroot, 64 characters a level,
    blank where a node is alone; ``group_segment`` those from there to the root.
    Null and empty texts have digests of their own (``-`` and ``0:``).  Columns
    not named are ignored.  An empty table gives an empty result.
    """
    extra = extra or {}
    named = F.col(f"`{group}`").cast("string")
    leaves = cut(docs.select(F.when(named.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), named)).alias("g"), F.col(f"`{id_col}`").alias("doc_id"),
                             leaf_of([F.col(f"`{c}`") for c in columns]).alias("node"), *[v.alias(c) for c, v in extra.items()]))
    carry = ["doc_id", *extra]
    tiers, subroots = trees(numbered(leaves, ["doc_id", "node"]), carry)
    of_groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("root").alias("node"))
    group_tiers, root = trees(numbered(of_groups, ["of"]), ["of"])
    paths = cut(segments(group_tiers, root, ["of"]).select(F.col("of").alias("g"), F.col("node").alias("subroot"), F.col("place").alias("group_place"),
                                                          F.col("segment").alias("group_segment"), "root"))
    return (segments(tiers, paths, carry)
            .select("doc_id", F.col("node").alias("leaf"), "place", "segment", "subroot", "group_place", "group_segment", "root", *extra))


def proven(leaf: Column) -> Column:
    """The root that ``leaf`` and the siblings of a row of the manifest lead to."""
    return folded(folded(leaf, F.col("place"), F.col("segment")), F.col("group_place"), F.col("group_segment"))


def tamper_check(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Where 7 divides the CRC-32 of the id's decimal text, n_chars is one more when
    the root is folded; a null n_chars stays and a null id is not tampered with.
    Otherwise as ``manifest``.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    more = F.when(chosen, F.col("n_chars").cast("decimal(38,0)") + 1)
    values = [more if c == "n_chars" else F.col(c) for c in COLUMNS]
    rows = manifest(docs, extra={"changed": F.when(more.isNotNull(), leaf_of(values))})
    rows = rows.withColumn("folded_root", proven(F.coalesce("changed", "leaf")))
    siblings = F.replace(F.concat("segment", "group_segment"), F.lit(" "), F.lit(""))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


MANIFEST_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, source, CAST(n_chars AS VARCHAR) AS chars, text,
         list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS crc,
         CAST(n_chars::HUGEINT + 1 AS VARCHAR) AS more
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256({head} || {chars} || {tail}) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0 AND more IS NOT NULL THEN sha256({head} || {more} || {tail}) END AS changed FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
grown AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(array_to_string(nodes[i + 1:i + 2], ''))) FROM grown WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM grown WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(array_to_string(nodes[i + 1:i + 2], ''))) FROM top WHERE len(nodes) > 1),
beside AS (
  SELECT p.lang, p.place, g.level, (p.place >> g.level) % 2 AS right_one, coalesce(g.nodes[xor(p.place >> g.level, 1) + 1], '') AS sibling
  FROM placed p JOIN grown g ON p.lang IS NOT DISTINCT FROM g.lang AND len(g.nodes) > 1
  UNION ALL
  SELECT p.lang, p.place, 1000 + t.level, (s.place >> t.level) % 2, coalesce(t.nodes[xor(s.place >> t.level, 1) + 1], '')
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN top t ON len(t.nodes) > 1),
paths AS (SELECT lang, place, list(right_one || sibling ORDER BY level) AS path FROM beside GROUP BY lang, place)
SELECT p.doc_id, p.leaf, s.subroot, r.nodes[1] AS root, sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x[2:]), '')) AS proof_sha256,
       list_reduce(list_concat([coalesce(changed, leaf)], coalesce(path, [])), lambda a, x: sha256(CASE WHEN x[1] = '1' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root,
       folded_root = r.nodes[1] AS verified
FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang JOIN top r ON len(r.nodes) = 1
LEFT JOIN paths w ON p.lang IS NOT DISTINCT FROM w.lang AND p.place = w.place
"""


def _value_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value})) || ':' || {value} END"


MANIFEST_SQL = MANIFEST_SQL.format(head=" || ".join(map(_value_sql, ("CAST(doc_id AS VARCHAR)", "source", "lang"))), tail=_value_sql("text"),
                                   chars=_value_sql("chars"), more=_value_sql("more"))
