"""Readings: the record type, line parsing and ingest adapters.

A reading is ``(id string, timestamp bigint, temp double)``; tidemark adds
``seq bigint``, the arrival number, because readings of one key can share a
timestamp and every ordered operator orders by ``(ts, seq)``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_micros, ntz_from_micros

READING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("temp", T.DoubleType(), False),
])

SEQ_READING_SCHEMA = T.StructType(READING_SCHEMA.fields + [
    T.StructField("seq", T.LongType(), False),
])

# Test mapping of the driver's ``events`` table onto readings (fixed values).
ARRIVAL_MULTIPLIER = 7919
ARRIVAL_SPREAD_SECONDS = 21600


_UNIT_MICROS = {"s": 1_000_000, "ms": 1_000, "us": 1}


def _event_time(number: Column, unit: str) -> Column:
    """Epoch number -> TIMESTAMP_NTZ holding the UTC wall clock."""
    if unit not in _UNIT_MICROS:
        raise ValueError(f"unknown time unit {unit!r}")
    return ntz_from_micros(number.cast("bigint") * F.lit(_UNIT_MICROS[unit]))


# ---------------------------------------------------------------- sources

def from_rows(spark: SparkSession, rows: Iterable[tuple], with_seq: bool = True) -> DataFrame:
    """In-memory collection of (id, timestamp, temp) tuples; seq = position."""
    rows = list(rows)
    if with_seq:
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SEQ_READING_SCHEMA)
    return spark.createDataFrame(rows, READING_SCHEMA)


def from_mixed(spark: SparkSession, values: Iterable) -> DataFrame:
    """Elements of mixed type as text (``from_elements`` keeps their types)."""
    return spark.createDataFrame([(None if v is None else str(v),) for v in values], "value string")


def from_elements(spark: SparkSession, values: Iterable) -> DataFrame:
    """Elements of mixed type as ``value variant`` (with ``seq``, their position): each keeps its own type.

    Python values of JSON types, None, dates, times and decimals.
    """
    def sql(v) -> Column:
        if v is None or isinstance(v, (bool, int, float, str, bytes, Decimal, date, datetime)):
            return F.to_variant_object(F.array(F.lit(v))) if v is not None else F.parse_json(F.lit("[null]"))
        return F.parse_json(F.lit(json.dumps([v])))

    values = list(values)
    if not values:
        return spark.createDataFrame([], "seq long").select("seq", F.parse_json(F.lit("null")).alias("value"))
    one = spark.range(1).select(F.posexplode(F.array(*[F.variant_get(sql(v), "$[0]", "variant") for v in values])).alias("seq", "value"))
    return one.select(F.col("seq").cast("long").alias("seq"), "value")


def mixed(*columns: str) -> Column:
    """Columns of different types as one array of variants, in order: NULLs stay out of it."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.variant_get(F.to_variant_object(F.array(F.col(c))), "$[0]", "variant")) for c in columns]))


def typed(value: Column | str, kind: str) -> Column:
    """The variant as ``kind`` if it is one (integers of any width count as ``bigint``), else NULL: no cast between kinds.

    ``kind`` is bigint, double, decimal, string, boolean, date or timestamp.
    """
    v = F.col(value) if isinstance(value, str) else value
    own = F.regexp_replace(F.schema_of_variant(v), r"\(.*\)", "")
    if kind in ("double", "decimal"):  # a fraction in text (JSON) is a decimal
        return F.when(own.isin("DOUBLE", "FLOAT", "DECIMAL"), F.try_variant_get(v, "$", "double" if kind == "double" else "decimal(38,18)"))
    names = {"bigint": ["BIGINT"], "string": ["STRING"], "boolean": ["BOOLEAN"], "date": ["DATE"], "timestamp": ["TIMESTAMP", "TIMESTAMP_NTZ"]}[kind]
    return F.when(own.isin(*names), F.try_variant_get(v, "$", kind))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s), one string per line; ``seq`` numbers the lines in file
    order: by file path, then position. Spark packs file pieces into tasks by
    size, so the number is built from line counts per piece (one row each)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"),
                                         F.col("_metadata.file_block_start").alias("_s"),
                                         F.monotonically_increasing_id().alias("_m"))
    pieces = lines.groupBy("_f", "_s").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    before = Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return lines.join(pieces, ["_f", "_s"]).select("value", (F.col("_off") + F.col("_m") - F.col("_m0")).alias("seq"))


def read_lines_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files as a stream (run with ``availableNow``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def read_socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket lines (never replayable; for demos only)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def replay_table_stream(spark: SparkSession, directory: str, schema: T.StructType,
                        files_per_trigger: int = 1, fmt: str = "parquet") -> DataFrame:
    """A user-defined source re-aimed: replay a written table as a stream."""
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", files_per_trigger).load(directory))


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str,
                   name: str | None = None, stream: bool = False) -> DataFrame:
    """CSV with a declared schema, no header, fail on malformed rows."""
    r = (spark.readStream if stream else spark.read).schema(schema).option("mode", "FAILFAST")
    df = r.csv(path)
    if name:
        df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------- parsing

def parse_reading(lines: DataFrame, col: str = "value", strict: bool = True,
                  sep: str = ",") -> DataFrame:
    """CSV line -> (id, timestamp, temp), keeping every other column.

    Fields 0, 1, 2 are used and extra fields are ignored. ``strict`` fails the
    job on a line whose number fields do not parse (or that has too few
    fields); otherwise such fields are NULL and ``parse_ok`` flags the row so
    it can be routed to a quarantine output.
    """
    parts = F.split(F.col(col), re.escape(sep), -1)
    ts_raw = F.try_element_at(parts, F.lit(2))
    temp_raw = F.try_element_at(parts, F.lit(3))
    ts = F.expr("try_cast(_ts_raw AS BIGINT)")
    temp = F.expr("try_cast(_temp_raw AS DOUBLE)")
    others = [c for c in lines.columns if c != col]
    df = (lines.withColumn("_ts_raw", ts_raw).withColumn("_temp_raw", temp_raw)
          .withColumn("_ts", ts).withColumn("_temp", temp))
    ok = F.col("_ts").isNotNull() & F.col("_temp").isNotNull()
    if strict:  # a filter, so that no choice of columns, nor a count, prunes the check
        bad = F.raise_error(F.concat(F.lit("malformed reading: "), F.coalesce(F.col(col), F.lit("NULL"))))
        df = df.where(F.when(ok, F.lit(True)).otherwise(bad.cast("boolean")))
        return df.select(F.element_at(parts, 1).alias("id"), F.col("_ts").alias("timestamp"),
                         F.col("_temp").alias("temp"), *others)
    return df.select(F.element_at(parts, 1).alias("id"), F.col("_ts").alias("timestamp"),
                     F.col("_temp").alias("temp"), *others, ok.alias("parse_ok"))


def reading_line(df: DataFrame) -> Column:
    """The CSV line ``id,timestamp,temp`` for a readings frame."""
    return F.concat_ws(",", F.col("id"), F.col("timestamp").cast("string"), F.col("temp").cast("string"))


# ---------------------------------------------------------------- adapters

def as_readings(df: DataFrame, id: str = "id", timestamp: str = "timestamp", temp: str = "temp",
                seq: str | None = "seq", unit: str = "s", ts_name: str = "ts") -> DataFrame:
    """Rename to (id, ts, temp, seq) and add the event-time column.

    ``unit`` says what the number in ``timestamp`` counts: ``s``, ``ms`` or
    ``us``. The event time is a TIMESTAMP_NTZ holding the UTC wall clock, so
    batch results do not depend on the session zone; ``with_event_time``
    turns it into a TIMESTAMP for a streaming watermark.
    """
    cols = [F.col(id).alias("id"), F.col(timestamp).alias("timestamp"),
            _event_time(F.col(timestamp), unit).alias(ts_name), F.col(temp).alias("temp")]
    if seq:
        cols.append(F.col(seq).alias("seq"))
    return df.select(*cols)


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Cast a TIMESTAMP_NTZ column to TIMESTAMP (needed for a watermark)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def events_readings(spark: SparkSession, sf_dir: str, id_col: str = "event_type") -> DataFrame:
    """The driver's ``events`` table as readings.

    id = ``event_type`` (or ``user_id`` as text), ts = ``ts`` (kept
    TIMESTAMP_NTZ so batch results do not depend on the session zone),
    temp = ``value``, seq = ``event_id``, timestamp = epoch seconds.
    Only these columns are read from the file.
    """
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    ident = F.col(id_col).cast("string") if id_col != "event_type" else F.col("event_type")
    return ev.select(
        ident.alias("id"),
        F.col("ts"),
        F.floor(epoch_micros("ts") / F.lit(1_000_000)).cast("bigint").alias("timestamp"),
        F.col("value").alias("temp"),
        F.col("event_id").alias("seq"),
    )


def with_arrival(df: DataFrame, spread_seconds: int = ARRIVAL_SPREAD_SECONDS,
                 ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Deterministic out-of-order arrival: ts + pmod(seq * 7919, spread) s.

    Arrival order is ``(arrival, seq)``.
    """
    shift = F.pmod(F.col(seq) * F.lit(ARRIVAL_MULTIPLIER), F.lit(spread_seconds))
    return df.withColumn("arrival", F.timestamp_add("SECOND", shift, F.col(ts)))


def epoch_millis_text(ms: Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds as the JVM's date text, e.g.
    ``Thu Sep 03 06:03:30 UTC 2020``, in a fixed zone (not the session's)."""
    ntz = F.timestamp_add("MILLISECOND", ms, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz)
    return F.date_format(local, f"EEE MMM dd HH:mm:ss '{zone}' yyyy")
