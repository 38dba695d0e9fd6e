"""Tokenising with JVM split semantics, and word counts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col
from tidemark.llm.common import bound_batches

#: Bytes of lines in a bucket of the rolling word count, about; bytes of rows that a task counts at once, and lines, about.
BUCKET_BYTES, HELD_BYTES, LINES_AT_ONCE = 16_000_000, 8_000_000, 10_000


def jvm_split(c: Column | str, sep: str, regex: bool = False) -> Column:
    """``String.split(sep)`` as the JVM does it, as an array column.

    Trailing empty strings are dropped, leading ones kept; an empty input
    gives one empty string and an input made only of separators gives none.
    ``sep`` is a literal unless ``regex`` is set.
    """
    c = col(c)
    pat = sep if regex else re.escape(sep)
    if not regex and len(sep) == 1:
        # one literal character: trimming it off the end is exact and cheap
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, f"(?:{pat})+\\z", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pat, -1)))


def tokens(df: DataFrame, c: str, sep: str = " ", word: str = "word",
           drop_empty: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per token of column ``c`` (flatMap(_.split(sep)))."""
    out = df.select(*(keep or []), F.explode(jvm_split(c, sep)).alias(word))
    if drop_empty:
        out = out.where(F.col(word) != F.lit(""))
    return out


def word_count(df: DataFrame, c: str, sep: str = " ", drop_empty: bool = False) -> DataFrame:
    """(word, count) over all lines. The batch form keeps empty words; the
    streaming form of the reference drops them (``drop_empty=True``).

    ``groupBy`` aggregates map-side first, so a very frequent word ships one
    partial count per task, not its rows.
    """
    return (tokens(df, c, sep, drop_empty=drop_empty)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def rolling_word_count(df: DataFrame, c: str, order: list[str], sep: str = " ") -> DataFrame:
    """The streaming word count's per-record output: after every non-empty
    token, the running count of that word, in arrival order (``order`` of
    the line, then the token's position).

    Lines are cut into buckets of the order before tokenising. A table of
    (word, bucket) counts, made batch by batch, tells how often a word occurs
    before each bucket; the lines themselves go to their bucket's task whole,
    one exchange of the input, and are counted there as they come in order.
    Tokens are neither shuffled nor sorted on Spark. Lines that share all order
    values take turns by position, so those go token by token. A task
    remembers the distinct words of one bucket.
    """
    from tidemark.operators import ordered

    spark = df.sparkSession
    bound_batches(spark)
    size = df.agg(F.sum(F.octet_length(c))).first()[0] or 0
    by = ordered.buckets(df, order, max(2 * spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES)))
    # literal splits of a line without its trailing separators are the JVM's, but for empty tokens
    line = col(c) if len(sep) == 1 else F.regexp_replace(c, f"(?:{re.escape(sep)})+\\z", "")
    lines = df.where(col(c).isNotNull()).select(*order, by.column.alias(ordered.BUCKET), line.alias("word"))

    counts = (lines.select(ordered.BUCKET, "word").mapInArrow(_bucket_counts(sep), f"{ordered.BUCKET} int, word string, n long")
              .groupBy("word", ordered.BUCKET).agg(F.sum("n").alias("n")))
    earlier = Window.partitionBy("word").orderBy(ordered.BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before = (counts.withColumn("count", F.sum("n").over(earlier)).where(F.col("count").isNotNull())
              .select(ordered.BUCKET, "word", "count", F.lit(1).alias(ordered.CTX)))

    repeated = df.groupBy(*[F.col(o).alias(f"_r{i}") for i, o in enumerate(order)]).agg(F.count(F.lit(1)).alias("_times")).where(F.col("_times") > 1)
    if repeated.isEmpty():
        parts = lines.withColumn("pos", F.lit(0))
    else:
        marked = lines.join(repeated, ordered.same(lines, repeated, [(o, f"_r{i}") for i, o in enumerate(order)]), "left")
        parts = marked.select(*order, ordered.BUCKET, F.posexplode(
            F.when(F.col("_times").isNull(), F.array("word")).otherwise(jvm_split("word", sep))).alias("pos", "word"))
    parts = (parts.withColumn(ordered.CTX, F.lit(0)).unionByName(before, allowMissingColumns=True)
             .repartition(ordered.BUCKET).sortWithinPartitions(ordered.BUCKET, F.col(ordered.CTX).desc(), *order, "pos"))
    schema = T.StructType([*(df.schema[o] for o in order), T.StructField("pos", T.IntegerType()),
                           T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])
    return parts.mapInArrow(_counter(order, sep, ordered.BUCKET, ordered.CTX), schema)


def _split(lines: pa.Array, sep: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of every non-empty token of the lines: its line, its place in it, and the token."""
    lists = pc.split_pattern(lines, pattern=sep)
    line = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    words = pc.list_flatten(lists)
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    place = np.arange(len(line)) - (np.cumsum(sizes) - sizes)[line]
    some = pc.not_equal(words, "")
    kept = some.to_numpy(zero_copy_only=False)
    return line[kept], place[kept], words.filter(some)


def _grouped(code: np.ndarray) -> np.ndarray:
    """The places of small numbers in their order, equal ones as they come (numpy sorts 16 bits in linear time)."""
    at = np.argsort((code & 0xFFFF).astype(np.uint16), kind="stable")
    if len(code) and code.max() > 0xFFFF:
        at = at[np.argsort((code >> 16).astype(np.uint16)[at], kind="stable")]
    return at


def _bucket_counts(sep: str):
    """(bucket, line) to (bucket, word, n), each word of a bucket once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LINES_AT_ONCE):
                lines = batch.slice(start, LINES_AT_ONCE)
                line, _, words = _split(lines.column(1), sep)
                coded = words.dictionary_encode()
                here, bucket = np.unique(lines.column(0).to_numpy(), return_inverse=True)
                width = max(len(coded.dictionary), 1)
                key = bucket[line] * width + coded.indices.to_numpy()
                if len(here) == 1:
                    n = np.bincount(key, minlength=len(coded.dictionary))
                    key = np.arange(len(n))
                else:
                    key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(here[key // width], pa.int32()), coded.dictionary.take(pa.array(key % width)),
                                                  pa.array(n, pa.int64())], names=[lines.schema.names[0], "word", "n"])

    return run


def _counter(order: list[str], sep: str, bucket: str, context: str):
    """Rows in order, the words met before a bucket ahead of its lines, to tokens with their running count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        known, known_n = pa.array([], pa.large_string()), np.zeros(0, np.int64)  # words met so far, and how often

        def met(words: list[pa.Array], n: list[np.ndarray]) -> None:
            nonlocal known, known_n
            known = pa.concat_arrays([known, *(w.cast(pa.large_string()) for w in words)])
            known_n = np.concatenate([known_n, *n])

        def settle() -> Iterator[pa.RecordBatch]:
            """Rows held of one kind: earlier counts are remembered, lines are counted."""
            nonlocal held, size
            rows, held, size = held, [], 0
            if not rows:
                return
            if rows[0].column(context)[0].as_py():
                met([r.column("word") for r in rows], [r.column("count").to_numpy() for r in rows])
                return
            lines = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            line, place, words = _split(lines.column("word"), sep)
            coded = words.dictionary_encode()
            code, distinct = coded.indices.to_numpy(), coded.dictionary
            found = pc.index_in(distinct.cast(pa.large_string()), value_set=known)
            new = found.is_null()
            at = found.fill_null(0).to_numpy()
            old = ~new.to_numpy(zero_copy_only=False)
            base = np.zeros(len(distinct), np.int64)
            base[old] = known_n[at[old]]
            times = np.bincount(code, minlength=len(distinct))
            count = np.empty(len(code), np.int64)
            count[_grouped(code)] = np.arange(1, len(code) + 1) + np.repeat(base - (np.cumsum(times) - times), times)
            known_n[at[old]] += times[old]
            met([distinct.filter(new)], [times[~old]])
            pos = lines.column("pos").to_numpy()[line] + place
            row = pa.array(line)
            yield pa.RecordBatch.from_arrays([*(lines.column(o).take(row) for o in order), pa.array(pos, pa.int32()), words, pa.array(count)],
                                             names=[*order, "pos", "word", "count"])

        for whole in batches:
            b, ctx = whole.column(bucket).to_numpy(), whole.column(context).to_numpy()
            cuts = (np.flatnonzero((b[1:] != b[:-1]) | (ctx[1:] != ctx[:-1])) + 1).tolist()
            for i, j in zip([0, *cuts], [*cuts, len(b)]):
                if i == j:
                    continue
                if (b[i], ctx[i]) != now:
                    yield from settle()
                    if now is None or b[i] != now[0]:
                        known, known_n = known[:0], known_n[:0].copy()
                    now = (b[i], ctx[i])
                held.append(whole.slice(i, j - i))
                size += pc.sum(pc.binary_length(held[-1].column("word"))).as_py() or 0
                if size > HELD_BYTES:
                    yield from settle()
        yield from settle()

    return run
