"""Group windows (tumbling, sliding, session, count) and OVER row frames.

Time windows are ``groupBy(key, window(...))``: Spark aggregates map-side
per (key, window) before the shuffle, so a hot key costs one partial row per
task and window. Windows are aligned to the epoch, as in the reference.
Row-count frames use the skew-safe look-back scan of ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_micros, nan_min, nan_min_over, ntz_from_micros
from tidemark.operators import ordered

ORDER = ("ts", "seq")
ARRIVAL = ("seq",)


def tumble(df: DataFrame, size: str, key: str = "id", ts: str = "ts") -> DataFrame:
    """Tumbling window: (id, count, avg temp, window end); end is exclusive."""
    return (df.groupBy(key, F.window(ts, size).alias("w"))
            .agg(F.count(key).alias("cnt"), F.avg("temp").alias("avg_temp"))
            .select(key, "cnt", "avg_temp", F.col("w.end").alias("window_end")))


def tumble_sql(spark: SparkSession, view: str, size_sql: str) -> DataFrame:
    """The same through SQL; ``size_sql`` is an interval literal text such as
    ``'1 hour'``. ``window(...).end`` plays ``tumble_end``."""
    return spark.sql(f"""
        SELECT id, count(id) AS cnt,
               avg(temp) AS avg_temp,
               window(ts, {size_sql}).end AS window_end
        FROM {view}
        GROUP BY id, window(ts, {size_sql})""")


def window_aggregate(df: DataFrame, body: Sequence[Column], size: str, slide: str | None = None,
                     key: str = "id", ts: str = "ts") -> DataFrame:
    """A user's body over time windows: (id, window start, the aggregates of ``body``)."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (df.groupBy(key, w.alias("w")).agg(*body)
            .select(key, F.col("w.start").alias("window_start"), *_names(df, body)))


def window_process(df: DataFrame, body, schema: str, size: str, slide: str | None = None,
                   key: str = "id", ts: str = "ts") -> DataFrame:
    """A user's function over the whole rows of each window: ``body(key, window_start, rows)``
    gets a pandas frame and returns one of ``schema``.

    The rows of one (key, window) meet in one task, so prefer
    ``window_aggregate`` where an aggregate can say it.
    """
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    rows = df.withColumn("_w", w).withColumn("window_start", F.col("_w.start")).drop("_w")
    return rows.groupBy(key, "window_start").applyInPandas(lambda k, pdf: body(k[0], k[1], pdf), schema)


def _names(df: DataFrame, body: Sequence[Column]) -> list[str]:
    return df.limit(0).agg(*body).columns


def sliding_count(df: DataFrame, size: str, slide: str, key: str = "id", ts: str = "ts") -> DataFrame:
    """Full-window function (id, window start in ms, row count as int)."""
    out = window_aggregate(df, [F.count(F.lit(1)).cast("int").alias("cnt")], size, slide, key, ts)
    return out.select(key, (epoch_micros("window_start") / 1000).cast("bigint").alias("window_start_ms"), "cnt")


def window_reduce(df: DataFrame, size: str, slide: str | None = None, key: str = "id",
                  ts: str = "ts") -> DataFrame:
    """Incremental window reduce: (id, window start, max timestamp, min temp; NaN if any is)."""
    return window_aggregate(df, [F.max("timestamp").alias("timestamp"), nan_min("temp").alias("temp")], size, slide, key, ts)


def session_count(df: DataFrame, gap_s: int, key: str = "id", ts: str = "ts",
                  order: Sequence[str] = ORDER) -> DataFrame:
    """Event-time session windows with an inactivity gap: (id, start, end, count).

    A row joins its key's session while it is at most ``gap`` after the
    previous row (windows ``[t, t + gap)`` that touch are merged, as the
    reference's session assigner does); the session ends ``gap`` after its
    last row. Built on the ordered scan, not on ``session_window``, whose
    batch plan sorts a whole key in one task: the previous time is an
    exclusive running max, the session start a running max of session-opening
    times, then one map-side aggregate per session.
    """
    us = gap_s * 1_000_000
    d = df.select(key, *order).withColumn("_t", epoch_micros(ts))
    by = ordered.buckets(d, order)  # one bucketing for both passes
    d = ordered.running(d, [key], order, {"_p": ("max", "_t", False)}, by=by)
    opens = F.col("_p").isNull() | (F.col("_t") - F.col("_p") > F.lit(us))
    d = ordered.running(d.withColumn("_o", F.when(opens, F.col("_t"))), [key], order,
                        {"_s": ("max", "_o")}, by=by)
    return (d.groupBy(key, "_s").agg(F.max("_t").alias("_e"), F.count(F.lit(1)).alias("cnt"))
            .select(key, ntz_from_micros("_s").alias("session_start"),
                    ntz_from_micros(F.col("_e") + F.lit(us)).alias("session_end"), "cnt"))


def processing_time_tumble(df: DataFrame, size: str, key: str = "id") -> DataFrame:
    """Tumbling window on processing time (one clock value per micro-batch)."""
    return (df.withColumn("proc_ts", F.current_timestamp())
            .groupBy(key, F.window("proc_ts", size).alias("w"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(key, F.col("w.start").alias("window_start"), "cnt"))


def count_window(df: DataFrame, size: int, key: str = "id", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Sliding count window (size rows, slide 1) with the reduce function:
    after each arrival, over the key's last <= ``size`` rows: row count, max
    timestamp, min temp (NaN if any is)."""
    k = size - 1
    cols = {
        "cnt": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-k, 0)),
        "max_timestamp": lambda w: F.max("timestamp").over(w.rowsBetween(-k, 0)),
        "min_temp": lambda w: nan_min_over("temp", w.rowsBetween(-k, 0)),
    }
    keep = list(dict.fromkeys([key, "timestamp", "temp", *order]))
    out = ordered.with_lookback(df.select(*keep), [key], order, k, cols)
    return out.select(key, *order, "cnt", "max_timestamp", "min_temp")


def over_rows(df: DataFrame, preceding: int = 2, key: str = "id", order: Sequence[str] = ORDER) -> DataFrame:
    """OVER (PARTITION BY id ORDER BY ts ROWS n PRECEDING): count and avg temp."""
    cols = {
        "cnt": lambda w: F.count("temp").over(w.rowsBetween(-preceding, 0)),
        "avg_temp": lambda w: F.avg("temp").over(w.rowsBetween(-preceding, 0)),
    }
    out = ordered.with_lookback(df.select(key, "temp", *order), [key], order, preceding, cols)
    return out.select(key, *order, "cnt", "avg_temp")


def over_rows_sql(spark: SparkSession, view: str, preceding: int = 2) -> DataFrame:
    """The same through a SQL named window (WINDOW ow AS (...)).

    The statement runs over a view whose rows carry their bucket and the
    context rows of the bucket, so no key is one window partition:
    ``PARTITION BY id, _b``.
    """
    name = f"{view}_bucketed"
    ordered.bucketed(spark.table(view).select("id", "ts", "seq", "temp"), ["id"], ORDER, preceding).createOrReplaceTempView(name)
    return spark.sql(f"""
        SELECT id, ts, seq, cnt, avg_temp FROM (
            SELECT id, ts, seq, {ordered.CTX}, count(temp) OVER ow AS cnt, avg(temp) OVER ow AS avg_temp
            FROM {name}
            WINDOW ow AS (PARTITION BY id, {ordered.BUCKET} ORDER BY ts, seq ROWS BETWEEN {preceding} PRECEDING AND CURRENT ROW))
        WHERE {ordered.CTX} = 0""")


__all__ = ["tumble", "tumble_sql", "window_aggregate", "window_process", "sliding_count", "window_reduce", "session_count",
           "processing_time_tumble", "count_window", "over_rows", "over_rows_sql"]
