"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key divided by its quality weight (so a
better document tends to come earlier). A source whose target is k times its
size or more gives k complete epochs; the rest of the target is filled in key
order, prefix-summed to the word. No source is ever sorted whole: keys fall into
value buckets, bucket sums tell which bucket holds the end of the budget, and
only that bucket is put in order to find the one document that is cut. A row
then needs its source's line of figures alone.

Buckets are equal steps of the key's logarithm. An exponential draw x has
there the density x exp(-x), at most 1/e, and a weight only shifts it; so for any
mixture of weights a step of e/buckets expects at most 1/buckets of a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, n_words
from tidemark.session import checkpoint_dir

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MAX_EPOCHS = 3
SEED = 17
#: Documents that share a key bucket, about, if they were all of one source.
ROWS_PER_BUCKET = 2_000
#: A line for each source is broadcast up to this many sources (100 bytes each).
BROADCAST_SOURCES = 50_000


def quality(text: Column) -> Column:
    """Quality weight: the share of letters among the characters, at least 0.05."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.greatest(F.lit(0.05), letters / F.greatest(F.length(text), F.lit(1)))


def uniform(id_col: Column, seed: int) -> Column:
    """A number inside (0, 1) from the id alone, so that reruns and retries agree."""
    digits = F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(2**48))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_size, target); one line a source.

    All sizes are shared by weight; a target stops at max_epochs times its
    source's size and the excess is reshared. In the order of cap over weight
    the capped sources are a prefix: the first source that its share of what
    is left does not fill sets the level of all behind it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = F.array(*[F.lit(int(x)) for x in weights])
    df = sizes.withColumn("w", F.get(w, (F.row_number().over(by_name) - 1) % len(weights)).cast("long"))
    df = df.withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap") / F.col("w"))
    df = (df.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
          .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
          .withColumn("level", F.col("left") / F.col("w_left")))
    df = df.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(whole)["level"])
    return df.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def with_keys(docs: DataFrame, buckets: int, seed: int, weight: Column) -> DataFrame:
    key = -F.log(uniform(F.col("doc_id"), seed)) / weight
    return (docs.withColumn("size", n_words(F.col("text"))).withColumn("key", key)
            .withColumn("tie", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))))
            .withColumn("bucket", F.floor(F.log("key") * (buckets / math.e))))


def plan(keyed: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One line a source: size, target, epochs and where its fractional epoch is cut."""
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long"))
    src = F.col("source").alias("src")
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    at = sums.withColumn("below", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    at = at.join(goal.select(src, "budget"), F.col("source").eqNullSafe(F.col("src")))
    at = at.where("budget > below and budget <= below + words").select("src", "bucket", "below", "budget")
    inside = keyed.select("source", "bucket", "key", "tie", "size").join(
        at.withColumnRenamed("bucket", "cut_bucket"), F.col("source").eqNullSafe(F.col("src")) & (F.col("bucket") == F.col("cut_bucket")))
    units = inside.groupBy("src", "key", "tie").agg(F.sum("size").alias("unit"), F.first("below").alias("below"), F.first("budget").alias("budget"))
    units = units.withColumn("before", F.col("below") + F.coalesce(F.sum("unit").over(
        Window.partitionBy("src").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cut = units.where("budget > before and budget <= before + unit").select(
        "src", F.col("key").alias("cut_key"), F.col("tie").alias("cut_tie"), F.col("unit").alias("cut_unit"), (F.col("budget") - F.col("before")).alias("cut_words"))
    return goal.select(src.alias("own"), "source_size", "target", "epochs").join(cut, F.col("own").eqNullSafe(F.col("src")), "left").drop("src")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        weight: Column | None = None) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target and taken.

    ``taken`` counts the words that the mix takes of a row: its size for each
    complete epoch, and once more if it comes before its source's cut; the
    row at the cut gives what the budget lacks. Rows of equal id in a source
    share a key, and at the cut they share what is taken by size. Null text
    has size 0 and is never taken; null sources are one source; columns of
    these names in ``docs`` are replaced. The texts are never shuffled while
    sources are few; a source of any share of the rows costs no more.
    """
    spark = docs.sparkSession
    own = ["size", "source_size", "target", "taken", "key", "tie", "bucket", "own", "epochs", "cut_key", "cut_tie", "cut_unit", "cut_words"]
    docs = docs.drop(*own)
    weight = quality(F.col("text")) if weight is None else weight
    buckets = max(1, math.ceil(docs.count() / ROWS_PER_BUCKET))
    keyed = with_keys(docs, buckets, seed, weight)
    checkpoint_dir(spark)
    narrow = keyed.select("source", "bucket", "key", "tie", "size").checkpoint()  # texts are counted for the plan once
    lines = plan(narrow, weights, max_epochs).checkpoint()
    if lines.count() <= BROADCAST_SOURCES:
        lines = F.broadcast(lines)
    out = keyed.join(lines, F.col("source").eqNullSafe(F.col("own")), "left")
    order, cut = F.struct("key", "tie"), F.struct(F.col("cut_key"), F.col("cut_tie"))
    part = F.when(F.col("cut_key").isNull() | (order > cut), 0).when(order < cut, F.col("size")).otherwise(
        F.floor(F.col("cut_words") * F.col("size") / F.col("cut_unit")))
    return out.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long")).select(
        *docs.columns, "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
             -ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':{SEED}'), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
              / greatest(0.05::DOUBLE, length(regexp_replace(coalesce(text, ''), '[^\p{{L}}]+', '', 'g'))::DOUBLE / greatest(length(coalesce(text, '')), 1)) AS key FROM documents),
  s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
  w AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w FROM s),
  r AS (SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w AS ratio FROM w),
  l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level
        FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  g AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(level, ratio) FROM l WHERE ratio >= level) * w) AS target FROM l),
  e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM g),
  p AS (SELECT d.doc_id, d.size, e.*, CAST(floor(target - epochs * source_size + 0.5::DOUBLE) AS BIGINT) AS budget,
          coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, budget - below)) AS BIGINT) AS taken FROM p"""
