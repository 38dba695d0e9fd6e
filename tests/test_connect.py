"""User-defined sources and sinks: offsets and restarts, life of a connection, failed tasks, batches run again."""
import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fixture_rows import rows
from tidemark.sources import connect

READINGS = "id string, temp double, seq bigint"


@pytest.fixture(scope="module")
def table(spark):
    path = f"{tempfile.mkdtemp(prefix='tidemark-replay-')}/t"
    (spark.range(0, 900, 1, 3).select(F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("id"), (F.col("id") / 4).alias("temp"), F.col("id").alias("seq"))
     .write.option("parquet.block.size", 1024).parquet(path))
    return path


def _run(df, path, checkpoint):
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
        return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()


def test_replay_equals_the_table_and_goes_on_at_its_offset(spark, table):
    base = tempfile.mkdtemp(prefix="tidemark-replay-out-")
    s = connect.replay_stream(spark, table, batch_rows=250, task_rows=40, progress=f"{base}/progress")
    assert _run(s, f"{base}/out", f"{base}/ck") == [250, 250, 250, 150]
    assert rows(spark.read.parquet(f"{base}/out")) == rows(spark.read.parquet(table))
    # a restart finds nothing new; rows that are added later are the only ones it reads
    assert _run(connect.replay_stream(spark, table, batch_rows=250, progress=f"{base}/progress"), f"{base}/out", f"{base}/ck") == []
    spark.createDataFrame([("z", 1.0, 10_000)], READINGS).coalesce(1).write.parquet(f"{base}/more")
    extra = next(f for f in os.listdir(f"{base}/more") if f.endswith(".parquet"))
    os.link(f"{base}/more/{extra}", f"{table}/zzz-last.parquet")
    assert _run(connect.replay_stream(spark, table, batch_rows=250, progress=f"{base}/progress"), f"{base}/out", f"{base}/ck") == [1]
    assert rows(spark.read.parquet(f"{base}/out")) == rows(spark.read.parquet(table))


def test_a_source_of_two_functions(spark):
    base = tempfile.mkdtemp(prefix="tidemark-squares-")
    for n in (7, 25):  # without a progress file: all there is after a start
        s = connect.user_stream(spark, "tidemark_squares", "n bigint, square bigint", lambda n=n: n, lambda a, b: ((i, i * i) for i in range(a, b)), batch_rows=10, task_rows=3)
        assert sum(_run(s, f"{base}/out", f"{base}/ck")) == (7 if n == 7 else 18)
    assert rows(spark.read.parquet(f"{base}/out")) == [(i, i * i) for i in range(25)]


class Failing(connect.TableSink):
    """Fails in the task that meets row 6 until the file ``ok`` exists; notes what is called."""

    def note(self, what):
        open(f"{self.path}-notes/{what}-{os.urandom(4).hex()}", "w").close()

    def write(self, connection, batch):
        super().write(connection, batch)
        if 6 in batch.column(0).to_pylist() and not os.path.exists(f"{self.path}-ok"):
            raise RuntimeError("lost")

    def close(self, connection):
        super().close(connection)
        self.note("close")

    def abort(self, told, batch_id):
        super().abort(told, batch_id)
        self.note("abort")


def test_a_failed_task_leaves_nothing_and_a_batch_that_is_run_again_is_there_once(spark):
    base = tempfile.mkdtemp(prefix="tidemark-sink-")
    os.makedirs(f"{base}/t-notes")
    src, sink = f"{base}/in", Failing(f"{base}/t")
    spark.range(0, 10, 1, 5).write.parquet(src)
    stream = lambda: spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 10).parquet(src)
    with pytest.raises(StreamingQueryException):
        connect.start_user_sink(stream(), sink, f"{base}/ck")
    assert sink.read(spark, "id bigint").count() == 0
    notes = [n.split("-")[0] for n in os.listdir(f"{base}/t-notes")]
    assert notes.count("abort") == 1 and "close" in notes
    assert not os.path.isdir(f"{base}/t/files") or not os.listdir(f"{base}/t/files")
    open(f"{base}/t-ok", "w").close()
    connect.start_user_sink(stream(), sink, f"{base}/ck")
    assert rows(sink.read(spark, "id bigint")) == [(i,) for i in range(10)]
    os.remove(f"{base}/ck/commits/0")  # as if the driver was lost between the sink's commit and Spark's
    for extra in (".0.crc",):
        if os.path.exists(f"{base}/ck/commits/{extra}"):
            os.remove(f"{base}/ck/commits/{extra}")
    connect.start_user_sink(stream(), sink, f"{base}/ck")
    assert rows(sink.read(spark, "id bigint")) == [(i,) for i in range(10)]
