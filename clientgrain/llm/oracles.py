"""What some of the queries give, as plain SQL over all pairs or by definition.

These are for checking on small tables: they compare everything with everything.
"""

from __future__ import annotations

import math

from . import quality_rules as rules
from .buckets import SHINGLE_WORDS, THRESHOLD
from .passage_dedup import MIN_WORDS
from .vector_dedup import THRESHOLD as COSINE

WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"


def shingle_sql(words: str) -> str:
    """The distinct runs of words of a list, joined by a character no word holds; fewer words are one run."""
    return (f"list_distinct(list_transform(range(1, greatest(1, len({words}) - {SHINGLE_WORDS - 1}) + 1), "
            f"lambda i: array_to_string({words}[i:i + {SHINGLE_WORDS - 1}], chr(10))))")


def linked_sql(items: str, key: str) -> str:
    """``pairs`` of similar items and ``reach``, the smallest key each item reaches; items have ``key`` and ``grams``."""
    return f"""
grams AS (SELECT {key}, len(grams) AS size, unnest(grams) AS gram FROM {items}),
pairs AS (SELECT a.{key} AS a, b.{key} AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.{key} <> b.{key}
          GROUP BY a.{key}, b.{key}, a.size, b.size HAVING count(*) >= {THRESHOLD} * (a.size + b.size - count(*))),
{reach_sql(items, key)}"""


def reach_sql(items: str, key: str) -> str:
    return f"""walk AS (SELECT {key} AS a, {key} AS b FROM {items} UNION SELECT walk.a, pairs.b FROM walk JOIN pairs ON walk.b = pairs.a),
reach AS (SELECT a, min(b) AS least FROM walk GROUP BY a)"""


NGRAM_JOIN_SQL = f"""
WITH RECURSIVE worded AS (SELECT DISTINCT doc_id, {WORDS.format(text='text')} AS words FROM documents WHERE doc_id IS NOT NULL),
sets AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE {shingle_sql('words')} END AS grams FROM worded),
{linked_sql('sets', 'doc_id')},
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
same AS (SELECT a.doc_id, min(b.doc_id) AS least FROM sets a JOIN sets b ON list_sort(a.grams) = list_sort(b.grams) AND len(a.grams) > 0 GROUP BY a.doc_id)
SELECT s.doc_id, r.least AS class_id, coalesce(l.n, 0) AS n_links, coalesce(m.least, s.doc_id) AS same_set_id
FROM sets s JOIN reach r ON s.doc_id = r.a LEFT JOIN links l ON s.doc_id = l.a LEFT JOIN same m ON s.doc_id = m.doc_id
"""

VECTOR_DEDUP_SQL = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {COSINE}),
{reach_sql('vectors', 'vec_id')},
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, coalesce(l.n, 0) AS n_links, r.least AS component_id, r.least = v.vec_id AS kept
FROM vectors v JOIN reach r ON v.vec_id = r.a LEFT JOIN links l ON v.vec_id = l.a
"""

PASSAGE_DEDUP_SQL = f"""
WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number
                         FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
placed AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY number) - length(line) - 1 AS "start", {WORDS.format(text='line')} AS words FROM lines),
paragraphs AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS place FROM placed WHERE len(words) > 0),
keyed AS (SELECT *, list_sort({shingle_sql('words')}) AS grams FROM paragraphs),
sets AS (SELECT grams, row_number() OVER (ORDER BY grams) AS id FROM (SELECT DISTINCT grams FROM keyed)),
{linked_sql('sets', 'id')},
clustered AS (SELECT k.doc_id, k.number, k.place, k."start", length(k.line) AS size, len(k.words) AS n_words, r.least AS cluster
              FROM keyed k JOIN sets s ON k.grams = s.grams JOIN reach r ON s.id = r.a),
firsts AS (SELECT *, min((doc_id, number)) OVER (PARTITION BY cluster) AS first FROM clustered),
repeats AS (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM firsts WHERE (doc_id, number) <> first),
summed AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, run) AS together FROM repeats)
SELECT doc_id, CAST(number AS INT) AS paragraph, CAST("start" AS BIGINT) AS "start", CAST("start" + size AS BIGINT) AS "end", CAST(n_words AS INT) AS n_words,
       first[1] AS first_doc_id, CAST(first[2] AS INT) AS first_paragraph
FROM summed WHERE together >= {MIN_WORDS}
"""


def quality_sql() -> str:
    value = {"symbols_per_word": "n_symbols / greatest(n_words, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
             "repeat_word_share": "n_repeat_words / greatest(n_words, 1)", "chars_per_word": "word_chars / greatest(n_words, 1)"}
    failed = f"(n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"
    cells = " UNION ALL ".join(
        f"SELECT lang, source, {i} AS m, floor(ln(1 + {rules.RESOLUTION} * ({value[m.name]})) / {math.log(rules.GROWTH)!r}) AS cell FROM counted WHERE NOT {failed}"
        for i, m in enumerate(rules.MEASURES))
    spread = "CASE m " + " ".join(f"WHEN {i} THEN {m.least_spread}" for i, m in enumerate(rules.MEASURES)) + " END"

    def of(cell: str) -> str:
        return f"(exp(({cell} + 0.5) * {math.log(rules.GROWTH)!r}) - 1) / {rules.RESOLUTION}"

    def level(keys: str) -> str:
        by = f"PARTITION BY {keys + ', ' if keys else ''}m"
        return (f"SELECT {keys + ', ' if keys else ''}m, n, {of('low')} AS q1, {of('high')} AS q3 FROM (SELECT {keys + ', ' if keys else ''}m, any_value(total) AS n, "
                f"min(CASE WHEN upto >= ceil(total * 0.25) THEN cell END) AS low, min(CASE WHEN upto >= ceil(total * 0.75) THEN cell END) AS high "
                f"FROM (SELECT *, sum(1) OVER ({by} ORDER BY cell) AS upto, count(*) OVER ({by}) AS total FROM cells) GROUP BY {keys + ', ' if keys else ''}m)")

    def shrunk(n: str, own: str, above: str) -> str:
        return f"(({n} * {own} + {rules.WEIGHT} * {above}) / ({n} + {rules.WEIGHT}))"
    q1, q3 = (shrunk("f.n", f"f.{q}", shrunk("c.n", f"c.{q}", f"w.{q}")) for q in ("q1", "q3"))
    drawn = (f"SELECT lang, source, m, low - {rules.REACH}::DOUBLE * greatest(high - low, spread) AS least, high + {rules.REACH}::DOUBLE * greatest(high - low, spread) AS most "
             f"FROM (SELECT f.lang, f.source, f.m, {q1} AS low, {q3} AS high, {spread.replace('CASE m', 'CASE f.m').replace('END', 'END::DOUBLE')} AS spread "
             "FROM fine f JOIN coarse c ON f.m = c.m AND f.lang IS NOT DISTINCT FROM c.lang JOIN whole w ON w.m = f.m)")
    inside = " AND ".join(
        f"coalesce((SELECT most >= {value[m.name]}" + (f" AND least <= {value[m.name]}" if m.both else "")
        + f" FROM limits l WHERE l.m = {i} AND l.lang IS NOT DISTINCT FROM counted.lang AND l.source IS NOT DISTINCT FROM counted.source), true)"
        for i, m in enumerate(rules.MEASURES))
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs),
positions AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM worded),
windows AS (SELECT rid, pos, word AS w1, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM positions WINDOW o AS (PARTITION BY rid ORDER BY pos)),
often AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, w1, w2, w3) AS n FROM windows WHERE w3 IS NOT NULL),
covered AS (SELECT rid, count(DISTINCT spot) AS n FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS spot FROM often WHERE n > 1) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT line) AS d FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
counted AS (SELECT w.rid, w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(l.n - l.d, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM worded w LEFT JOIN lines l ON w.rid = l.rid LEFT JOIN covered c ON w.rid = c.rid),
cells AS ({cells}),
fine AS ({level('lang, source')}), coarse AS ({level('lang')}), whole AS ({level('')}), limits AS ({drawn})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, NOT {failed} AND {inside} AS kept FROM counted
"""
