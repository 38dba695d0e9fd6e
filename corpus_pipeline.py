"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; between stages the rows are a Parquet table. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, pii, sentencepiece_codec, simhash
from tidemark.llm.common import bound_batches
from tidemark.llm.queries import piece_model
from tidemark.session import checkpoint_dir

#: A language below this score counts as rejected (two even duels score 0.25).
LEAST_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay; those without a letter or below the least score go. A null lang gets the predicted one."""
    bound_batches(spark)
    found = langid.identify(docs, langid.train(docs))
    found = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the least id stays."""
    bound_batches(spark)
    return simhash.one_of_each(docs, simhash.simhash_groups(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; spans of personal data become their kind in angle brackets, and n_chars follows."""
    bound_batches(spark)
    out = pii.redacted(docs, pii.train(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their targets: a document stands once for each epoch that takes it, at the cut if at least half of it is taken."""
    mixed = mixing.mix(docs)
    copies = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int")
    return mixed.where(copies > 0).select(*docs.columns, F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    bound_batches(spark)
    model = piece_model()
    return sentencepiece_codec.round_trip(docs.select("doc_id", "text", "lang", "source"), model).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("language", language), ("near_copies", near_copies), ("personal_data", personal_data), ("mix", mix), ("tokens", tokens)]

#: Fitted models, iterated links and subword merges have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them go to the shared checkpoint folder."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
