"""Event time per arrival: watermarks, late rows, lateness-aware windows.

The reference runs its watermark with parallelism 1, so it covers all keys:
the watermark before a row is ``max(event time of earlier arrivals) - delay``.
That is a running max with no partition key; ``ordered.running`` with no
keys computes it in buckets of the order (a per-bucket max, a prefix over
the bucket table, then a window per bucket), never in one task.

Times are handled as epoch microseconds of the UTC wall clock, so results do
not depend on the session zone. The reference's unit is the millisecond: a
window's last instant is ``end - 1 ms``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_micros, ntz_from_micros
from tidemark.operators import ordered

ARRIVAL_ORDER = ("arrival", "seq")
US = 1_000_000
MS = 1_000


def periodic_watermark(df: DataFrame, delay_s: int, ts: str = "ts",
                       order: Sequence[str] = ARRIVAL_ORDER, name: str = "watermark") -> DataFrame:
    """Bounded out-of-orderness: after each arrival, max event time so far - delay."""
    out = ordered.running(df.withColumn("_t", epoch_micros(ts)), [], order, {"_m": ("max", "_t")})
    return out.withColumn(name, ntz_from_micros(F.col("_m") - F.lit(delay_s * US))).drop("_t", "_m")


def punctuated_watermark(df: DataFrame, marker_id: str, minus_s: int = 1, ts: str = "ts",
                         order: Sequence[str] = ARRIVAL_ORDER, name: str = "watermark") -> DataFrame:
    """Only rows of ``marker_id`` advance the watermark, to their time - 1 s.

    NULL until the first marker row; never decreases.
    """
    cand = F.when(F.col("id") == F.lit(marker_id), epoch_micros(ts) - F.lit(minus_s * US))
    out = ordered.running(df.withColumn("_t", cand), [], order, {"_m": ("max", "_t")})
    return out.withColumn(name, ntz_from_micros(F.col("_m"))).drop("_t", "_m")


def max_disorder(df: DataFrame, ts: str = "ts", order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """How far behind the running max event time any arrival was: the delay
    a bounded-out-of-orderness watermark needs to lose no row. One row."""
    out = ordered.running(df.select(ts, *order).withColumn("_t", epoch_micros(ts)), [], order,
                          {"_m": ("max", "_t")})
    return out.agg(F.max(F.col("_m") - F.col("_t")).alias("max_disorder_us"))


def watermark_before(df: DataFrame, delay_s: int, ts: str = "ts",
                     order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Adds ``_t`` (event time, us) and ``_wm`` (watermark before the row, us; NULL at first)."""
    d = df.withColumn("_t", epoch_micros(ts))
    out = ordered.running(d, [], order, {"_m": ("max", "_t")}, inclusive=False)
    return out.withColumn("_wm", F.col("_m") - F.lit(delay_s * US)).drop("_m")


def _last_window_end(size_s: int, slide_s: int) -> F.Column:
    t = F.col("_t")
    return t - F.pmod(t, F.lit(slide_s * US)) + F.lit(size_s * US)


def late_rows(df: DataFrame, size_s: int, slide_s: int, delay_s: int, lateness_s: int,
              ts: str = "ts", order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """The late side output: rows every window of which had already closed.

    A (row, window) pair still counts while ``end - 1 ms + lateness`` is
    after the watermark before the row; a row is late when even its last
    window has closed.
    """
    w = watermark_before(df, delay_s, ts, order)
    closed = (_last_window_end(size_s, slide_s) - F.lit(MS) + F.lit(lateness_s * US)) <= F.col("_wm")
    return (w.where(F.col("_wm").isNotNull() & closed)
            .withColumn("watermark", ntz_from_micros(F.col("_wm")))
            .drop("_t", "_wm"))


def _reached(df: DataFrame, size_s: int, slide_s: int, delay_s: int, lateness_s: int, key: str, ts: str,
             order: Sequence[str]) -> DataFrame:
    """One row for each (row, window) that the row reaches before the window is dropped, with ``_start`` and ``_wm``."""
    if size_s % slide_s:
        raise ValueError("size must be a multiple of slide")
    w = watermark_before(df.select(key, ts, *order), delay_s, ts, order)
    start = (F.col("_t") - F.pmod(F.col("_t"), F.lit(slide_s * US)) - F.col("_j") * F.lit(slide_s * US))
    pairs = (w.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1))))
             .withColumn("_start", start))
    return pairs.where(F.col("_wm").isNull() | (F.col("_start") + F.lit(size_s * US - MS + lateness_s * US) > F.col("_wm")))


def window_firings(df: DataFrame, size_s: int, slide_s: int, delay_s: int, lateness_s: int,
                   key: str = "id", ts: str = "ts", order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Every firing of the sliding counts under allowed lateness: (id, window start, count, late).

    A window fires when the watermark reaches its end (at the end of the
    input at the latest) with the rows it has by then, and once more, with
    the count so far, for each later row that still reaches it.
    """
    reached = _reached(df, size_s, slide_s, delay_s, lateness_s, key, ts, order)
    late = F.coalesce(F.col("_start") + F.lit(size_s * US - MS) <= F.col("_wm"), F.lit(False))
    counted = ordered.running(reached.withColumn("late", late).select(key, "_start", "late", *order),
                              [key, "_start"], order, {"cnt": ("count", None)})
    on_time = counted.where(~F.col("late")).groupBy(key, "_start", "late").agg(F.max("cnt").alias("cnt"))
    out = on_time.unionByName(counted.where("late").select(key, "_start", "late", "cnt"))
    return out.select(key, (F.col("_start") / MS).cast("bigint").alias("window_start_ms"), F.col("cnt").cast("int").alias("cnt"), "late")


def sliding_count_lateness(df: DataFrame, size_s: int, slide_s: int, delay_s: int, lateness_s: int,
                           key: str = "id", ts: str = "ts",
                           order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Sliding event-time window counts with allowed lateness: the final
    count of each (id, window) over the rows that reached it in time."""
    reached = _reached(df, size_s, slide_s, delay_s, lateness_s, key, ts, order)
    return (reached.groupBy(key, "_start")
            .agg(F.count(F.lit(1)).cast("int").alias("cnt"))
            .select(key, (F.col("_start") / MS).cast("bigint").alias("window_start_ms"), "cnt"))
