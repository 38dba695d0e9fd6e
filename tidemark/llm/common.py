"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every contract here: space and U+0009 to U+000D.
#: ``bytes.split()`` cuts at exactly these; JVM code uses this pattern.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of a batch that Spark hands to a Python worker, where the session has no bound of its own.
BATCH_BYTES = 4_000_000
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches (Spark counts rows only, and 10,000 long texts are one batch), unless the session does."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), on the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that no other column can clash or travel."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The texts of a batch as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def chunks(batches: Iterator[pa.RecordBatch], size: int = 1_000_000, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``size`` bytes of text.

    Whole rows stay together: a longer text makes a chunk of its own.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(name))
        lens = [x or 0 for x in pa.compute.binary_length(col).to_pylist()]
        start, held = 0, 0
        for i, n in enumerate(lens):
            if i > start and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if len(lens) > start:
            yield batch.slice(start)
