import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Names that operators use for columns of their own; a table may have them too.
CLASHES = ("ids", "decoded", "size", "key", "tie", "bucket", "taken", "target", "fp", "least", "id", "ver", "start", "n",
           "anchor", "content", "spans", "grp", "next", "paragraphs", "root", "pii", "lang_pred", "score", "own", "a", "b")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing names."""
    long = "word " * 30_000 + "x" * 50_000
    rows = [(1, "Hello there, General.\nA second line.", "en", "b"), (2, None, None, None), (3, "", "en", "a"), (4, "   \t\n", "fr", "a"),
            (5, long, "en", "a"), (6, "Hello there, General.\nA second line.", "en", "b"), (6, "Hello there, General.\nA second line.", "en", "b"),
            (None, "no id at all", "de", "c"), (None, None, "de", None), (9, "12345 !!! ???", None, "b"), (10, "é中\U0001f600 ▁ x\x00y", "es", "é"),
            (11, "Hello there, General.\nA second line!", "en", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit(7) for c in CLASHES}).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
