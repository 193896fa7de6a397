"""Quality rules with thresholds learnt from each language and source.

Nobody knows a good cutoff for every source beforehand.  Each measure (symbols
per word, repeated lines, repeated words, word length) is summed up in a
quantile sketch for each (language, source): counts of logarithmic cells, which
merge by adding.  A text is refused if a measure lies outside the fence
``quartile +/- REACH * spread`` of its group.  The quartiles of a group of n texts
are drawn towards those of its language, and a language's towards those of
everything: their own weigh ``n / (n + WEIGHT)``, at every size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import broadcast_if_small, cut
from .texts import map_texts, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# Cells of the sketch grow by this factor, so a quantile is off by a hundredth at most.
GROWTH = 1.02
# The sketch counts ln(1 + RESOLUTION * value); smaller values share the first cells.
RESOLUTION = 1000.0
# As many texts weigh as much as the level above.
WEIGHT = 200
REACH = 3.0

BASE = T.StructType([T.StructField(n, T.LongType()) for n in
                     ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")])


@dataclass(frozen=True)
class Measure:
    """A share or length computed from the base counts.

    ``least_spread`` is the smallest distance between quartiles that is taken
    seriously: in a clean group most measures are 0 throughout, and one symbol
    is no outlier.  ``both`` fences the low side too.
    """
    name: str
    least_spread: float
    both: bool = False


MEASURES = (
    Measure("symbols_per_word", 0.1),
    Measure("dup_line_share", 0.15),
    Measure("repeat_word_share", 0.15),
    Measure("chars_per_word", 1.0, both=True),
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    if len(seen) < 2_000_000:
        v = np.int64(len(seen))
        windows = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * np.int64(len(seen)) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1].astype(np.int64) * np.int64(len(seen)) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0, 0, 0, 0, 0, 0)
    words = words_of(text)
    spaces = sum(text.count(c) for c in " \t\n\v\f\r")
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return (len(words), len(text) - spaces, sum(text.count(c) for c in SYMBOLS),
            len(lines), len(lines) - len(set(lines)), repeated_words(words))


def measure(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the base counts of every whole text (null: all 0)."""
    return map_texts(df, keep, [text], BASE, lambda: lambda columns: map(base_counts, columns[0]))


def values() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_word_share": F.col("n_repeat_words") / words,
        "chars_per_word": F.col("word_chars") / words,
    }


def cell(value: Column) -> Column:
    return F.floor(F.log1p(value * RESOLUTION) / math.log(GROWTH)).cast("int")


def cell_value(number: Column) -> Column:
    """The middle of a cell."""
    return F.expm1((number + F.lit(0.5)) * math.log(GROWTH)) / RESOLUTION


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, measure, cell, n): one mergeable sketch for each group and measure.

    Texts that fail the base rules are left out; they would widen the fences.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("measure"), cell(v).alias("cell"))
                                for i, v in enumerate(values().values())])).alias("c")
    return (measured.where(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), cells)
            .groupBy("lang", "source", "c.measure", "c.cell").agg(F.count("*").alias("n")))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Both quartiles of each group and measure from cell counts (merged by adding)."""
    merged = sketch.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "measure")
    running = merged.select("*", F.sum("n").over(by.orderBy("cell")).alias("upto"), F.sum("n").over(by).alias("total"))
    pick = {q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("cell"))) for q in (0.25, 0.75)}
    return (running.groupBy(*keys, "measure")
            .agg(pick[0.25].alias("low"), pick[0.75].alias("high"), F.first("total").alias("total")))


def shrunk(n: Column, own: Column, above: Column) -> Column:
    return (n * own + WEIGHT * above) / (n + WEIGHT)


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, least0, most0, ...): the lowest and highest accepted value of each measure in each group."""
    def level(keys: list[str], prefix: str) -> DataFrame:
        return quartiles(sketch, keys).select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], F.col("measure").alias(f"{prefix}measure"), F.col("total").alias(f"{prefix}n"),
                                              cell_value(F.col("low")).alias(f"{prefix}q1"), cell_value(F.col("high")).alias(f"{prefix}q3"))
    # One row for each measure.
    whole = {r["w_measure"]: r for r in level([], "w_").collect()}

    def of_all(name: str) -> Column:
        return F.coalesce(*[F.when(F.col("measure") == i, F.lit(r[name])) for i, r in whole.items()]) if whole else F.lit(None).cast("double")
    joined = level(["lang", "source"], "").join(level(["lang"], "c_"), F.col("lang").eqNullSafe(F.col("c_lang")) & (F.col("measure") == F.col("c_measure")))
    q1, q3 = (shrunk(F.col("n"), F.col(q), shrunk(F.col("c_n"), F.col(f"c_{q}"), of_all(f"w_{q}"))) for q in ("q1", "q3"))
    spread = F.coalesce(*[F.when(F.col("measure") == i, F.lit(m.least_spread)) for i, m in enumerate(MEASURES)])
    wide = F.lit(REACH) * F.greatest(F.col("high") - F.col("low"), spread)
    drawn = joined.select("lang", "source", "measure", q1.alias("low"), q3.alias("high")).select("lang", "source", "measure", (F.col("low") - wide).alias("least"), (F.col("high") + wide).alias("most"))
    return drawn.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == i, F.col(side))).alias(f"{side}{i}") for i in range(len(MEASURES)) for side in ("least", "most")])


def judge(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``, by the ``thresholds``.

    A null language or source is a group of its own.  A group in which every
    text fails the base rules has no fences and needs none.
    """
    limits = limits.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    inside = F.lit(True)
    for i, (m, value) in enumerate(zip(MEASURES, values().values())):
        inside = inside & (value <= F.col(f"most{i}"))
        if m.both:
            inside = inside & (value >= F.col(f"least{i}"))
    joined = measured.join(limits, F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left")
    failed = base_failed()
    return joined.select(*measured.columns, failed.alias("base_failed"),
                         F.when(failed, F.lit(False)).otherwise(F.coalesce(inside, F.lit(True))).alias("kept"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                  source: str = "source") -> DataFrame:
    """One row for each input row: id, base counts, ``base_failed``, ``kept``.

    Null and empty texts have no words and fail.  Repeated rows are judged
    alike, each with a row of its own.  Other columns are ignored, so their
    names cannot clash.  An empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    measured = cut(measure(slim, ["doc_id", "lang", "source"]))
    limits = cut(thresholds(sketches(measured, "lang", "source")))
    return judge(measured, broadcast_if_small(limits, limits.count())).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_rows(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged, whatever their columns are called.

    Repeated rows are judged alike and come as often as they came.  Otherwise as
    ``quality_rules``; an empty table stays empty.
    """
    keys = [F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")]
    limits = cut(thresholds(sketches(cut(measure(docs.select(*keys), ["lang", "source"])), "lang", "source")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys)
    judged = judge(measure(rows, ["row", "lang", "source"]), broadcast_if_small(limits, limits.count()))
    return judged.where("kept").select("row.*")
