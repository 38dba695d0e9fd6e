"""Routing one stream into several outputs: tag split, side output, connect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import above

HIGH, LOW = "high", "low"


def tag_split(df: DataFrame, threshold: float = 20.0, temp: str = "temp", tags: str = "tags") -> DataFrame:
    """Label each row ``high`` (temp above threshold) or ``low``.

    Labels are an array so a rule may give a row several; ``select_tag``
    picks one output. NaN goes low, as in the JVM.
    """
    return df.withColumn(tags, F.when(above(temp, threshold), F.array(F.lit(HIGH)))
                         .otherwise(F.array(F.lit(LOW))))


def select_tag(df: DataFrame, tag: str, tags: str = "tags") -> DataFrame:
    return df.where(F.array_contains(F.col(tags), tag)).drop(tags)


def split_rows(df: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Every (row, label) pair: the union of all selected outputs."""
    return (tag_split(df, threshold).select("*", F.explode("tags").alias("tag")).drop("tags"))


def side_output(df: DataFrame, threshold: float = 30.0) -> tuple[DataFrame, DataFrame]:
    """Main output: readings above the threshold, whole.
    Side output ``lowTemp``: the rest as (id, temp, timestamp).

    Both are filters over the same input; in a stream, run them in one
    ``foreachBatch`` so the input is read once.
    """
    hi = above("temp", threshold)
    main = df.where(hi)
    low = df.where(~hi).select("id", "temp", "timestamp", *[c for c in ("seq",) if c in df.columns])
    return main, low


def connect(warn: DataFrame, normal: DataFrame) -> DataFrame:
    """Co-map two differently shaped inputs into one output.

    ``warn`` rows become (id, temp, "warn"), ``normal`` rows (id, "normal");
    the union leaves temp NULL on normal rows.
    """
    extra = [c for c in ("seq",) if c in warn.columns and c in normal.columns]
    a = warn.select("id", "temp", F.lit("warn").alias("status"), *extra)
    b = normal.select("id", F.lit("normal").alias("status"), *extra)
    return a.unionByName(b, allowMissingColumns=True)


def split_connect(df: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Split at the threshold, project the high side to (id, temp), connect.

    The two sides partition the input, so the union of their co-mapped rows
    is one projection over one scan (``connect`` unions two real inputs).
    """
    hi = above("temp", threshold)
    extra = [c for c in ("seq",) if c in df.columns]
    return df.select("id", F.when(hi, F.col("temp")).alias("temp"),
                     F.when(hi, F.lit("warn")).otherwise(F.lit("normal")).alias("status"), *extra)
