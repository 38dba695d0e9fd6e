"""The registered query of each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    embedding_dedup, filter_audit, langid, lexical_search, line_dedup, merkle, mixing, pii, sentencepiece_codec, simhash, substring_dedup,
    token_counts, toxicity)

Query = Callable[[SparkSession, str], DataFrame]


def piece_model() -> bytes:
    """The public 32k BPE model, by the path that its package names."""
    import public_tokenizers

    return sentencepiece_codec.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_sentencepiece(spark, sf):
    return sentencepiece_codec.digests(_table(spark, sf, "documents"), piece_model())


def op2_token_counts(spark, sf):
    return token_counts.token_counts(_table(spark, sf, "documents"), piece_model())


def op3_substring_dedup(spark, sf):
    return substring_dedup.substring_query(_table(spark, sf, "documents"))


def op4_simhash(spark, sf):
    return simhash.simhash_groups(_table(spark, sf, "documents"))


def op5_toxicity(spark, sf):
    return toxicity.toxicity_query(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op6_language(spark, sf):
    return langid.language_query(_table(spark, sf, "documents"))


def op7_pii(spark, sf):
    return pii.pii_query(_table(spark, sf, "documents"))


def op8_mixing(spark, sf):
    return mixing.mix(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_embedding_dedup(spark, sf):
    return embedding_dedup.embedding_groups(_table(spark, sf, "embeddings"))


def op10_fingerprints(spark, sf):
    return merkle.fingerprints(_table(spark, sf, "documents"))


def op11_lexical_search(spark, sf):
    return lexical_search.search_query(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op12_line_dedup(spark, sf):
    return line_dedup.line_query(_table(spark, sf, "documents"))


def op13_filter_audit(spark, sf):
    return filter_audit.audit(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_sentencepiece, op2_token_counts, op3_substring_dedup, op4_simhash, op5_toxicity, op6_language, op7_pii, op8_mixing, op9_embedding_dedup, op10_fingerprints,
    op11_lexical_search, op12_line_dedup, op13_filter_audit)}

ORACLE: dict[str, str] = {"op8_mixing": mixing.ORACLE, "op10_fingerprints": merkle.ORACLE, "op11_lexical_search": lexical_search.ORACLE,
                          "op12_line_dedup": line_dedup.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
