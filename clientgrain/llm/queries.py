"""The ``opN_<name>`` queries over the test tables, each a thin use of its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import (html_text, license_scan, merkle, mixing, ngram_join, oracles, packing, passage_dedup,
               quality_model, quality_rules, token_counts, token_files, vector_dedup, whitening)
from .texts import table
from .tokens import tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op1_ngram_join": oracles.NGRAM_JOIN_SQL,
    "op2_mix_sources": mixing.MIX_SQL,
    "op5_vector_dedup": oracles.VECTOR_DEDUP_SQL,
    "op7_repeated_lines": oracles.PASSAGE_DEDUP_SQL,
    "op9_quality_rules": oracles.quality_sql(),
    "op13_merkle_manifest": merkle.MANIFEST_SQL,
}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query
def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_dedup(table(spark, sf_dir, "embeddings"))


@query
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.removals(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op7_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of ``op7_passage_dedup`` alone, which SQL can say."""
    return passage_dedup.repeated_paragraphs(table(spark, sf_dir, "documents"))


@query
def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    index = token_files.write_records(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return token_files.encoded_documents(index, folder)


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(table(spark, sf_dir, "embeddings"))


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that every content of the table is encoded."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "token-counts"), tokenizer_path("byte_bpe_50k.json"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))
