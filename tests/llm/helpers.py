"""Small awkward tables, and plain definitions to compare with."""

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or put out.
CLASHES = ("id", "key", "size", "kept", "n_words", "copies", "row", "hash", "label", "tile", "sketch", "class", "length", "p", "repeats", "drop")

LONG = " ".join(f"w{i * 7919 % 104729}" for i in range(60_000))
PROSE = " ".join(f"word{i % 97}x{i % 89}" for i in range(120))


def awkward_rows():
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t \r\n", None, None, 7), (None, PROSE + " nobody", "en", "b", 1),
        (5, LONG, "en", "a", len(LONG)), (6, PROSE, "en", "a", 1), (6, PROSE, "en", "a", 1), (7, PROSE, "de", "b", 1),
        (8, PROSE + " tail", "en", None, 1), (9, "one two", "en", "b", 7), (10, "one two", "en", "b", 7), (11, "one  two\n", "en", "b", 9),
        (12, "x" * 50_000, "en", "a", 50_000), (13, "é ü ñ 中文 😀 \x1c\x85", "fr", "c", 5), (14, "# # # # |", "en", "a", 9),
        (15, "\n".join([PROSE, "short line", PROSE + " again and again"]), "en", "c", 1), (-3, PROSE.upper(), "en", "a", 1),
    ]


def awkward(spark):
    df = spark.createDataFrame(awkward_rows(), DOCUMENTS)
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])


def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def similar(a, b, threshold=0.8):
    common = len(a & b)
    return bool(a) and bool(b) and common >= threshold * (len(a) + len(b) - common)


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def top(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
