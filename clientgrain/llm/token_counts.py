"""Token counts of whole texts, each content encoded once and for all.

The cache is a Parquet folder of (tokenizer, digest, n_tokens): ``tokenizer`` is a
digest of the vocabulary file, the library and its version, ``digest`` one of the
normalised content.  Contents are looked up by digest; only digests that the cache
lacks are encoded, one text of each, and appended.  Texts travel for misses only.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, cut, fits_broadcast
from .texts import map_texts
from .tokens import ID_BYTES, encoder

MOST_TOKENS = 512

CACHE = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("tokenizer", T.StringType())])


def library_of(path: str) -> str:
    return "sentencepiece" if path.endswith(".model") else "tokenizers"


def tokenizer_version(path: str) -> str:
    """A digest of all that the counts of a text depend on."""
    library = library_of(path)
    seen = hashlib.sha256(f"{library} {importlib.metadata.version(library)}\n".encode())
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            seen.update(block)
    return seen.hexdigest()


_pieces: dict[str, object] = {}


def counter(path: str) -> Callable[[Sequence[str]], list[int]]:
    """A function from texts to their numbers of tokens, as the vocabulary's library gives them."""
    if library_of(path) == "tokenizers":
        ids = encoder(path)
        return lambda texts: [len(b) // ID_BYTES for b in ids(texts)]
    if path not in _pieces:
        import sentencepiece
        _pieces[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in _pieces[path].encode(list(texts), num_threads=1)]


def normalised(text: Column) -> Column:
    """What is counted: the text as UTF-8, null as empty.

    Nothing else is folded together: the vocabularies tell case and every white space apart.
    """
    return F.coalesce(text.cast("string"), F.lit(""))


def digest_of(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; nothing if the folder is not there yet.

    Two runs that miss the same content at once both append it; it counts once.
    """
    try:
        rows = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE).select("digest", "n_tokens")
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def add_missing(texts: DataFrame, missing: DataFrame, n_missing: int, cache: str, path: str, version: str) -> None:
    """Encode one text of each missing digest of (digest, content) and append the counts to the cache."""
    if fits_broadcast(n_missing):
        one_of_each = texts.join(F.broadcast(missing), "digest", "left_semi").dropDuplicates(["digest"])
    else:
        # Copies fall together before the shuffle, so a content with a third of all rows is sent once a task.
        one_of_each = texts.dropDuplicates(["digest"]).join(missing, "digest", "left_semi")

    def make():
        count = counter(path)
        return lambda columns: ((n,) for n in count([t or "" for t in columns[0]]))

    counted = map_texts(one_of_each, ["digest"], ["content"], T.StructType([T.StructField("n_tokens", T.LongType())]), make)
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)


def token_counts(docs: DataFrame, cache: str, path: str, id_col: str = "doc_id", text: str = "text", most: int = MOST_TOKENS) -> DataFrame:
    """One row for each input row: doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``most`` tokens).

    ``path`` names a vocabulary (``.json`` for tokenizers, ``.model`` for
    sentencepiece) that all machines hold there; ``cache`` a folder that they
    share, made on first use.  No begin, end or added special tokens count;
    special strings inside texts are what the library makes of them.  A null
    text counts as empty and has no tokens.  Repeated rows come out as often as
    they came in; rows without id, too.  Other columns are ignored.  An empty
    table gives an empty result and leaves the cache as it is.
    """
    spark, version = docs.sparkSession, tokenizer_version(path)
    content = normalised(F.col(f"`{text}`"))
    keyed = cut(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.octet_length(content).cast("long").alias("n_bytes"), digest_of(content).alias("digest")))
    missing = cut(keyed.select("digest").distinct().join(cached(spark, cache, version), "digest", "left_anti"))
    n_missing = missing.count()
    if n_missing:
        add_missing(docs.select(digest_of(content).alias("digest"), content.alias("content")), missing, n_missing, cache, path, version)
    # As a table of its own the lookup is a plain join, whose large partitions Spark splits.
    wanted = cut(cached(spark, cache, version).join(keyed.select("digest").distinct(), "digest", "left_semi"))
    return (keyed.join(broadcast_if_small(wanted, wanted.count()), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > most).alias("over_limit")))
