"""Sinks: message payloads, keyed-latest upserts, database upsert, files, positional insert.

Payload builders return a column, so one function serves a batch write, a
``writeStream`` and a Kafka ``value``. Keyed sinks first reduce each key to
its last row (a group limit in each task, so a hot key ships one row per
task) and then write every key once: no two tasks ever hold one key.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sinks.runs import KeyedTable

# Fixed value: the record text of the reference's Kafka producer.
RECORD_NAME = "SensorReading"


# ---------------------------------------------------------------- payloads

def record_text(id: str = "id", timestamp: str = "timestamp", temp: str = "temp") -> Column:
    """``SensorReading(id,timestamp,temp)``: the case-class text of a reading."""
    return F.concat(F.lit(RECORD_NAME + "("), F.col(id), F.lit(","), F.col(timestamp).cast("string"),
                    F.lit(","), F.col(temp).cast("string"), F.lit(")"))


def document_json(id: str = "id", temp: str = "temp", time: str = "timestamp") -> Column:
    """The document sink's all-string map {id, temp, time} as JSON text."""
    return F.to_json(F.struct(F.col(id).cast("string").alias("id"),
                              F.col(temp).cast("string").alias("temp"),
                              F.col(time).cast("string").alias("time")))


def csv_payload(*cols: str) -> Column:
    """A CSV line of the given columns (the Kafka CSV table format)."""
    return F.to_csv(F.struct(*[F.col(c) for c in cols]))


def parse_csv_payload(value: Column | str, schema: str, strict: bool = True) -> Column:
    """Decode a CSV message value (e.g. a Kafka ``value``) into a struct.

    A value that does not fit the schema fails the job, or with ``strict``
    off gives NULL fields.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.from_csv(v.cast("string"), schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})


def write_kafka_stream(df: DataFrame, brokers: str, topic: str, checkpoint: str):
    """Start a Kafka sink (needs the Kafka connector on the classpath)."""
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


def read_kafka_stream(spark, brokers: str, topic: str) -> DataFrame:
    """Kafka topic as a stream of string values (brokers are required)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topic).load()
            .select(F.col("value").cast("string").alias("value")))


# ---------------------------------------------------------------- keyed

def keyed_latest(df: DataFrame, key: Column | str, value: Column | str,
                 order: Sequence[str] = ("seq",)) -> DataFrame:
    """Last writer wins per key: (key, value) of the last arrival (by ``order``).

    Each task keeps one row per key before the shuffle (a partial group limit).
    """
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(k.alias("key"), v.alias("value"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    w = Window.partitionBy("key").orderBy(*[F.col(f"_o{i}").desc() for i in range(len(order))])
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select("key", "value")


def upsert_to_path(batch: DataFrame, path: str, batch_id: int, key: str = "key") -> None:
    """Add a batch of rows, one per key, to the keyed table at ``path`` (levelled runs, see ``runs``).

    The batch is written as a run; full levels are merged, so a read touches a
    bounded number of runs however many batches there were. A batch id
    that was applied is skipped, so a replay changes nothing.
    """
    KeyedTable(batch.sparkSession, path, key).upsert(batch, batch_id)


def read_upserted(spark, path: str, key: str = "key") -> DataFrame:
    """The current content of a keyed table: each key's row of the last batch that has it. A NULL key is a key."""
    rows = KeyedTable(spark, path, key).read()
    if rows is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    return rows


def foreach_batch_upsert(path: str, key_col: str, value_col: Column | str, order: Sequence[str] = ("seq",)):
    """A ``foreachBatch`` function: reduce the micro-batch to each key's last arrival, then upsert."""
    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_to_path(keyed_latest(batch, key_col, value_col, order), path, batch_id)
    return run


def foreach_batch_documents(path: str, key_col: str = "id", temp: str = "temp", time: str = "timestamp",
                            order: Sequence[str] = ("seq",)):
    """A ``foreachBatch`` function: JSON documents upserted by key, each key's
    last document by arrival (the document index keyed by id)."""
    return foreach_batch_upsert(path, key_col, document_json(key_col, temp, time), order)


def dbapi_upsert(df: DataFrame, connect, table: str, key: str, value: str, order: Sequence[str] = ("seq",),
                 key_col: str = "sensor", value_col: str = "tempu", mark: str = "?", quote: str = "") -> None:
    """Update, else insert, into a database table: one write per key.

    Rows are reduced to one per key first, so no two tasks hold one key. Each
    task opens a connection with ``connect()`` (a DB-API 2 factory that
    executors can reach), updates every key and inserts those that were not
    there, in one transaction. A retried task finds its keys and updates them
    again. ``mark`` is the driver's parameter mark, ``quote`` the database's
    identifier quote.
    """
    k, v, t = (f"{quote}{c}{quote}" for c in (key_col, value_col, table))
    update = f"UPDATE {t} SET {v} = {mark} WHERE {k} = {mark}"
    insert = f"INSERT INTO {t} ({k}, {v}) VALUES ({mark}, {mark})"

    def write(rows) -> None:
        rows = iter(rows)
        first = next(rows, None)
        if first is None:
            return
        con = connect()
        try:
            cur = con.cursor()
            for r in chain([first], rows):
                cur.execute(update, (r["value"], r["key"]))
                if cur.rowcount == 0:
                    cur.execute(insert, (r["key"], r["value"]))
            con.commit()
        finally:
            con.close()

    keyed_latest(df, key, value, order).foreachPartition(write)


def labeled(df: DataFrame, label: str) -> DataFrame:
    """Prefix rows with a label, as ``print("label")`` does: one ``line`` column
    ``label> row`` for console or text sinks."""
    row = F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns])
    return df.select(F.concat(F.lit(f"{label}> "), row).alias("line"))


def console_stream(df: DataFrame, label: str | None = None, mode: str = "append"):
    """Start a console sink (the reference's ``print``), optionally labelled."""
    out = labeled(df, label) if label else df
    return out.writeStream.outputMode(mode).format("console").option("truncate", False).start()


# ---------------------------------------------------------------- tables

def insert_by_position(df: DataFrame, sink_columns: Sequence[str]) -> DataFrame:
    """Rename to the sink's columns by position (``count`` lands in ``cnt``)."""
    if len(sink_columns) != len(df.columns):
        raise ValueError(f"sink has {len(sink_columns)} columns, rows have {len(df.columns)}")
    return df.toDF(*sink_columns)


def foreach_batch_overwrite(path: str, fmt: str = "csv"):
    """A ``foreachBatch`` function writing the complete result each batch:
    how a grouped (updating) table reaches an append-only file sink."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(path)
    return run
