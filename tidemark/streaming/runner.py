"""Stream plumbing: file-stream readings, running to completion, windowed
stream aggregates with watermarks, and late-row routing.

Streams read a folder (files arrive over time); ``run`` starts a query with
a checkpoint location and ``trigger(availableNow=True)`` (or a processing
interval) so a restart on the same location continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import nan_min
from tidemark.sinks.runs import Files, Runs
from tidemark.sources import readings as rd
from tidemark.streaming import stateful

US = 1_000_000
MS = 1_000


def _line_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, second, file, start) to (value, place): second * 2**32 + the line's
    byte place in its file. A piece of a file is read in order, by one task."""
    piece, at = None, 0
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(0)), 0)) + 1
        seconds, starts = np.asarray(batch.column(1)), np.asarray(batch.column(3))
        files = np.asarray(batch.column(2).dictionary_encode().indices)
        names = batch.column(2)
        heads = np.flatnonzero(np.append(True, (files[1:] != files[:-1]) | (starts[1:] != starts[:-1]))) if len(files) else []
        place = np.zeros(len(sizes), np.int64)
        for i, j in zip(heads, [*heads[1:], len(sizes)]):
            own = (names[int(i)].as_py(), int(starts[i]))
            at = at if own == piece else own[1]
            piece = own
            ends = at + np.cumsum(sizes[i:j])
            place[i:j] = (seconds[i:j].astype(np.int64) << 32) + ends - sizes[i:j]
            at = int(ends[-1])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(place)], names=["value", "place"])


def readings_stream(spark: SparkSession, directory: str, fmt: str = "text",
                    files_per_trigger: int | None = 1, unit: str = "s",
                    schema: T.StructType | None = None) -> DataFrame:
    """Readings from a folder: CSV lines (``fmt="text"``) or a table with
    (id, timestamp, temp, seq) columns.

    A line's arrival number ``seq`` is its fourth field; of a line with three
    it is the second at which its file was written and the line's byte place
    in the file, so files arrive in turn and lines in file order.

    The event time ``ts`` is a TIMESTAMP so it can carry a watermark.
    """
    r = spark.readStream
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "text":
        lines = r.format("text").load(directory).select(
            "value", F.unix_seconds("_metadata.file_modification_time").alias("second"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        lines = lines.mapInArrow(_line_numbers, "value string, place bigint")
        field = F.try_element_at(F.split("value", ","), F.lit(4)).cast("bigint")
        parsed = rd.parse_reading(lines.select("value", F.coalesce(field, "place").alias("seq")))
    else:
        parsed = r.schema(schema or rd.SEQ_READING_SCHEMA).format(fmt).load(directory)
    out = rd.as_readings(parsed, unit=unit)
    return rd.with_event_time(out)


def run(df: DataFrame, name: str, checkpoint: str, mode: str = "append", fmt: str = "memory",
        path: str | None = None, available_now: bool = True, processing_time: str | None = None,
        foreach_batch=None):
    """Start ``df`` and, for ``availableNow``, wait until the input is drained."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
        if fmt == "memory":
            w = w.queryName(name)
        elif path:
            w = w.option("path", path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


# ------------------------------------------------------------ windowed streams

def tumble_stream(df: DataFrame, size: str, delay: str, key: str = "id") -> DataFrame:
    """Tumbling event-time window on a stream with a bounded-disorder watermark
    (append mode emits each window once, when the watermark passes its end)."""
    return (df.withWatermark("ts", delay).groupBy(key, F.window("ts", size).alias("w"))
            .agg(F.count(key).alias("cnt"), F.avg("temp").alias("avg_temp"))
            .select(key, "cnt", "avg_temp", F.col("w.end").cast("timestamp_ntz").alias("window_end")))


def sliding_count_stream(df: DataFrame, size: str, slide: str, delay: str, lateness: str | None = None,
                         key: str = "id") -> DataFrame:
    """Sliding window counts on a stream. Allowed lateness is a longer
    watermark delay (disorder + lateness): in update mode each late row
    that still counts refines its window again, as the reference does."""
    d = delay if lateness is None else _add_delays(delay, lateness)
    return (df.withWatermark("ts", d).groupBy(key, F.window("ts", size, slide).alias("w"))
            .agg(F.count(F.lit(1)).cast("int").alias("cnt"))
            .select(key, (F.unix_micros(F.col("w.start")) / MS).cast("bigint").alias("window_start_ms"), "cnt"))


def session_stream(df: DataFrame, gap_s: int, delay: str, key: str = "id") -> DataFrame:
    """Session windows on a stream with the table form's rule (touching windows
    merge; Spark's ``session_window`` would split at exactly the gap)."""
    out = stateful.apply(df.withWatermark("ts", delay).select(key, "ts"), key, stateful.Sessions(gap_s),
                         stateful.Sessions.SCHEMA, "append", "EventTime")
    ntz = lambda c: F.timestamp_add("MILLISECOND", F.col(c), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return out.select(F.col("id").alias(key), ntz("session_start_ms").alias("session_start"), ntz("session_end_ms").alias("session_end"), "cnt")


def running_count_stream(df: DataFrame, key: str = "id", name: str = "count") -> DataFrame:
    """keyBy(k).sum(1) on a stream: update mode emits each changed key's
    total once per micro-batch (the table form emits once per row)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def reduce_stream(df: DataFrame, key: str = "id") -> DataFrame:
    """The keyed reduce (max timestamp, min temp) on a stream, update mode:
    one refined row per changed key and micro-batch."""
    return df.groupBy(key).agg(F.max("timestamp").alias("timestamp"), nan_min("temp").alias("temp"))


def min_by_stream(df: DataFrame, key: str = "id") -> DataFrame:
    """minBy on a stream: the record holding each key's minimum so far
    (ties keep the earliest ``seq``), update mode."""
    rec = F.min_by(F.struct("timestamp", "temp", "seq"), F.struct("temp", "seq"))
    return df.groupBy(key).agg(rec.alias("r")).select(key, "r.*")


def _add_delays(a: str, b: str) -> str:
    return f"{_seconds(a) + _seconds(b)} seconds"


def _seconds(text: str) -> int:
    n, unit = text.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(n) * scale[unit.rstrip("s")]


# ------------------------------------------------------------ late rows

class LateRouter:
    """A ``foreachBatch`` function that splits each micro-batch into rows that
    still reach a sliding window and late rows (the late side output).

    The watermark for a batch is ``max(event time of earlier batches) -
    delay``. After each batch the running max so far is written under
    ``state_dir/batch=<id>``, so a batch reads one small file (its
    predecessor's) and a replayed batch sees the same watermark; files before
    the predecessor's are deleted, as no replay needs them. A row is
    late when even its last window closed: ``end - 1 ms + lateness <= watermark``. On-time and
    late rows go to their own parquet folders, one ``batch=<id>`` folder per
    micro-batch written with overwrite, so a replayed batch replaces itself.

    With ``marker_id`` the watermark is punctuated instead: only rows of that
    id advance it, to their event time - ``marker_minus_s`` (and ``delay_s``
    is not applied).
    """

    def __init__(self, state_dir: str, on_time_dir: str, late_dir: str,
                 size_s: int, slide_s: int, delay_s: int, lateness_s: int,
                 marker_id: str | None = None, marker_minus_s: int = 1, key: str = "id"):
        self.state_dir, self.on_time_dir, self.late_dir = state_dir, on_time_dir, late_dir
        self.size_s, self.slide_s, self.delay_s, self.lateness_s = size_s, slide_s, delay_s, lateness_s
        self.marker_id, self.marker_minus_s, self.key = marker_id, marker_minus_s, key

    def _advance(self, t):
        """The per-row value whose running max drives the watermark."""
        if self.marker_id is None:
            return t
        return F.when(F.col(self.key) == F.lit(self.marker_id), t - F.lit(self.marker_minus_s * US))

    def _max_before(self, spark: SparkSession, batch_id: int):
        if batch_id == 0:
            return None
        if f"batch={batch_id - 1}" not in Files(spark, self.state_dir).names(""):  # nothing seen yet; damage is an error
            return None
        row = spark.read.schema("max_us bigint").parquet(f"{self.state_dir}/batch={batch_id - 1}").first()
        return None if row is None else row.max_us

    def _watermark(self, spark: SparkSession, batch_id: int):
        m = self._max_before(spark, batch_id)
        if m is None:
            return None
        return m if self.marker_id is not None else m - self.delay_s * US

    def _save_max(self, spark: SparkSession, batch_id: int, batch_max) -> None:
        prev = self._max_before(spark, batch_id)
        vals = [v for v in (prev, batch_max) if v is not None]
        if vals:
            (spark.createDataFrame([(int(max(vals)),)], "max_us bigint")
             .write.mode("overwrite").parquet(f"{self.state_dir}/batch={batch_id}"))
        files = Files(spark, self.state_dir)
        for name in files.names(""):
            number = name.removeprefix("batch=")
            if number.isdigit() and int(number) < batch_id - 1:
                files.delete(name)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wm = self._watermark(spark, batch_id)
        t = F.unix_micros("ts")
        last_end = t - F.pmod(t, F.lit(self.slide_s * US)) + F.lit(self.size_s * US)
        late = F.lit(False) if wm is None else (last_end - F.lit(MS) + F.lit(self.lateness_s * US) <= F.lit(wm))
        tagged = batch.withColumn("_late", late).persist()
        tagged.where(~F.col("_late")).drop("_late").write.mode("overwrite").parquet(
            f"{self.on_time_dir}/batch={batch_id}")
        tagged.where(F.col("_late")).drop("_late").write.mode("overwrite").parquet(
            f"{self.late_dir}/batch={batch_id}")
        mx = tagged.agg(F.max(self._advance(t)).alias("max_us")).first().max_us
        tagged.unpersist()
        self._save_max(spark, batch_id, mx)


class LatenessWindowCounts(LateRouter):
    """Sliding-window counts with allowed lateness on a stream, exactly as the
    reference keeps rows: a (row, window) pair counts while the window's
    ``end - 1 ms + lateness`` is after the watermark before the batch, even
    when the row itself is behind the watermark (Spark's own watermark drops
    such rows, so this runs in ``foreachBatch`` instead of ``withWatermark``).

    The counts are a table of levelled runs at ``counts_dir``: each batch adds
    its partial counts, full levels are summed into one run, and a replayed
    batch is skipped. So a read of many batches touches few files, and every
    batch refines the windows it touched.
    """

    def __init__(self, state_dir: str, counts_dir: str, size_s: int, slide_s: int,
                 delay_s: int, lateness_s: int, key: str = "id"):
        super().__init__(state_dir, "", "", size_s, slide_s, delay_s, lateness_s, key=key)
        self.counts_dir = counts_dir

    def _runs(self, spark: SparkSession) -> Runs:
        def summed(rows: DataFrame) -> DataFrame:
            return rows.groupBy(self.key, "window_start_ms").agg(F.sum("cnt").alias("cnt"))

        return Runs(spark, self.counts_dir, summed, [self.key, "window_start_ms"])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        wm = self._watermark(spark, batch_id)
        t = F.unix_micros("ts")
        n = self.size_s // self.slide_s
        tt = F.col("_t")
        start = tt - F.pmod(tt, F.lit(self.slide_s * US)) - F.col("_j") * F.lit(self.slide_s * US)
        pairs = (batch.select(self.key, t.alias("_t"))
                 .withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
                 .withColumn("_start", start))
        if wm is not None:
            pairs = pairs.where(F.col("_start") + F.lit(self.size_s * US) - F.lit(MS)
                                + F.lit(self.lateness_s * US) > F.lit(wm))
        counts = (pairs.groupBy(self.key, "_start").agg(F.count(F.lit(1)).alias("cnt"))
                  .select(self.key, (F.col("_start") / MS).cast("bigint").alias("window_start_ms"), "cnt"))
        self._runs(spark).add(counts, batch_id)
        self._save_max(spark, batch_id, batch.agg(F.max(self._advance(t)).alias("m")).first().m)

    def read_counts(self, spark: SparkSession) -> DataFrame:
        """The counts so far; no rows before the first batch."""
        counts = self._runs(spark).read()
        if counts is None:
            return spark.createDataFrame([], f"`{self.key}` string, window_start_ms bigint, cnt int")
        return counts.withColumn("cnt", F.col("cnt").cast("int"))
