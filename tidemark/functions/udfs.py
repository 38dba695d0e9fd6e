"""User functions: scalar hash, average aggregate, split table function, top-2.

Each function has a column form (built-in expressions, stays in codegen) and
is registered for SQL by ``register(spark)``: SQL scalar and table functions
are defined with ``CREATE TEMPORARY FUNCTION`` so SQL calls also stay on the
JVM. The Python forms (a pandas aggregate UDF, a Python UDTF) exist for
users who want them; they are the slow path and hold a whole group in one
task, so registered queries use the native forms.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.text import jvm_split

# The rank-2 filler of the top-2 aggregate is the most negative
# finite double; the reference's hash factor is 11 and offset 10000.
DOUBLE_MIN = -1.7976931348623157e308
HASH_FACTOR = 11
HASH_OFFSET = 10000

# JVM String.hashCode over UTF-16 code units, folded natively; code points
# above U+FFFF count as their two surrogates. Then hash * factor - offset with
# 32-bit wrap-around (computed in BIGINT and masked: ANSI int math would throw).
_HASH_SQL = """
CAST(
  (((IF(char_length({s}) = 0, 0L,
      aggregate(
        transform(split({s}, ''), x -> ascii(x)),
        0L,
        (h, c) -> IF(c > 65535,
          (((h * 31 + (55296 + shiftright(c - 65536, 10))) & 4294967295L) * 31
             + (56320 + ((c - 65536) & 1023))) & 4294967295L,
          (h * 31 + c) & 4294967295L)))
    * {factor} - {offset}) & 4294967295L) + 2147483648L) % 4294967296L - 2147483648L
AS INT)"""


def _hash_sql(s: str, factor: str, offset: str = str(HASH_OFFSET)) -> str:
    return _HASH_SQL.format(s=s, factor=factor, offset=offset)


def hash_code(c: str, factor: int = HASH_FACTOR) -> Column:
    """``s.hashCode * factor - 10000`` as a 32-bit int, NULL for NULL."""
    q = ".".join(f"`{p}`" for p in c.split("."))
    return F.expr(_hash_sql(q, str(int(factor))))


def avg_temp(c: str = "temp") -> Column:
    """The average aggregate: accumulator (sum, count), result sum / count.

    Two-phase like any built-in aggregate: partial sums per task, merged
    after the shuffle. NaN gives NaN.
    """
    return F.avg(c)


def split_udtf(df: DataFrame, c: str, sep: str = "_", keep: list[str] | None = None,
               outer: bool = False) -> DataFrame:
    """Lateral join with the split table function: one (word, length) row
    per token; rows with no token vanish unless ``outer``."""
    gen = F.explode_outer if outer else F.explode
    out = df.select(*(keep or df.columns), gen(jvm_split(c, sep)).alias("word"))
    return out.withColumn("length", utf16_length("word"))


def utf16_length(c: str) -> Column:
    """String length in UTF-16 code units, as the JVM counts it."""
    return (F.octet_length(F.encode(F.col(c), "UTF-16BE")) / 2).cast("int")


def top2(df: DataFrame, key: str = "id", value: str = "temp", order_tie: str = "seq",
         sentinel: bool = True) -> DataFrame:
    """Table aggregate: the two highest values per key as (value, rank).

    Equal values count twice; NaN and values not above the most negative
    double are never taken. With ``sentinel`` every key yields ranks 1 and 2,
    filling a missing one with the most negative double.

    One shuffle: rows are ranked per key with eligible values first, and
    ``row_number() <= 2`` makes Spark keep two rows per key in each task
    before the shuffle (a partial ``WindowGroupLimit``), so a hot key ships
    two rows per task. The at most two survivors per key are then gathered
    (the window's partitioning already groups them) and the ranks filled.
    """
    v = F.col(value)
    eligible = (v > F.lit(DOUBLE_MIN)) & ~F.isnan(v)
    w = Window.partitionBy(key).orderBy(eligible.desc(), v.desc(), F.col(order_tie))
    top = (df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 2)
           .select(key, "_r", F.when(eligible, v).alias("_v")))
    if not sentinel:
        return top.where(F.col("_v").isNotNull()).select(key, F.col("_v").alias(value),
                                                         F.col("_r").alias("rank"))
    packed = top.groupBy(key).agg(F.collect_list(F.struct("_r", "_v")).alias("_a"))
    slot = lambda i: F.struct(
        F.coalesce(F.get(F.filter("_a", lambda x: x["_r"] == i), 0)["_v"], F.lit(DOUBLE_MIN)).alias(value),
        i.alias("rank"))
    return packed.select(key, F.inline(F.transform(F.array(F.lit(1), F.lit(2)), slot)))


# ------------------------------------------------------------ Python forms

@F.pandas_udf(T.DoubleType())
def avg_temp_udaf(t: pd.Series) -> float:
    """The average as a pandas aggregate UDF (batch only, no partial step)."""
    return float(t.sum() / t.count()) if t.count() else float("nan")


def _make_split_udtf():
    try:
        from pyspark.sql.functions import udtf
    except ImportError:  # pragma: no cover
        return None

    @udtf(returnType="word: string, length: int")
    class SplitWords:
        def eval(self, s: str, sep: str = "_"):
            if s is None:
                return
            parts = re.split(re.escape(sep), s)
            while parts and parts[-1] == "" and len(parts) > 1:
                parts.pop()
            if s != "" and parts == [""]:
                return
            for p in parts:
                yield p, len(p.encode("utf-16-be")) // 2

    return SplitWords


SplitWords = _make_split_udtf()


def register(spark: SparkSession) -> None:
    """Register every function for SQL: hash_code(s, factor), avg_temp_value(
    sum, count), split_words(s, sep) (table), avg_temp_udaf(x) and
    split_words_py(s, sep) (Python forms)."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION hash_code(s STRING, factor INT)
                  RETURNS INT RETURN {_hash_sql('s', 'factor')}""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION avg_temp_value(s DOUBLE, n BIGINT)
                 RETURNS DOUBLE RETURN s / n""")
    spark.sql(r"""CREATE OR REPLACE TEMPORARY FUNCTION split_words(s STRING, sep STRING)
                  RETURNS TABLE(word STRING, length INT)
                  RETURN SELECT w AS word,
                                CAST(octet_length(encode(w, 'UTF-16BE')) / 2 AS INT) AS length
                         FROM (SELECT explode(
                             CASE WHEN s = '' THEN array('')
                                  WHEN regexp_replace(s, concat('(?:\\Q', sep, '\\E)+\\z'), '') = ''
                                    THEN CAST(array() AS ARRAY<STRING>)
                                  ELSE split(regexp_replace(s, concat('(?:\\Q', sep, '\\E)+\\z'), ''),
                                             concat('\\Q', sep, '\\E'), -1)
                             END) AS w)""")
    spark.udf.register("avg_temp_udaf", avg_temp_udaf)
    if SplitWords is not None:
        spark.udtf.register("split_words_py", SplitWords)
