"""From raw documents to packed sequences: five stages, each one operator.

Every stage works on all that the stage before it kept.  All but the last return
the columns of ``documents``; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientgrain.llm import mixing, ngram_join, packing, passage_dedup, quality_rules
from clientgrain.llm.tokens import tokenizer_path
from clientgrain.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules refuse go."""
    return quality_rules.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all documents but the first."""
    return passage_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("n-gram join", near_duplicates), ("substring dedup", passages),
          ("mixing", mix), ("packing", pack)]

# The stages sketch, split and tokenize; SQL cannot say that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
