"""User-defined sources and sinks for streams, on Spark's Python data source interface.

A user source is two functions: ``latest()``, how many rows it has so far,
and ``fetch(start, end)``, the rows with these numbers. Spark keeps the
offsets in the query's checkpoint, so a restart goes on where it stopped, and
a batch that is run again fetches the same rows. A batch's rows are fetched in
several tasks.

A user sink has the life of a connection: ``open`` in each task, ``write`` for
its rows, ``close`` always; then one ``commit`` of the batch on the driver, or
``abort`` if a task failed for good. ``TableSink`` uses it: a batch becomes
visible by one manifest, so a failed task leaves nothing and a batch
that is run again is not there twice.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a micro-batch, and of one of its tasks.
BATCH_ROWS, TASK_ROWS = 1_000_000, 100_000


# ------------------------------------------------------------ sources

class _Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class _Progress:
    """A file that holds how many rows are done with, at most one batch behind Spark's own checkpoint."""

    def __init__(self, path: str):
        self.path = path

    def _system(self):
        return pafs.FileSystem.from_uri(self.path) if ":/" in self.path else (pafs.LocalFileSystem(), self.path)

    def read(self) -> int:
        system, path = self._system()
        if system.get_file_info(path).type != pafs.FileType.File:
            return 0
        with system.open_input_stream(path) as f:
            return int(f.read())

    def write(self, rows: int) -> None:
        system, path = self._system()
        system.create_dir(os.path.dirname(path), recursive=True)
        with system.open_output_stream(f"{path}.draft") as f:
            f.write(str(rows).encode())
        system.move(f"{path}.draft", path)


class _Reader(DataSourceStreamReader):
    def __init__(self, latest, fetch, batch_rows: int, task_rows: int, committed, progress: _Progress | None):
        self.latest, self.fetch, self.batch_rows, self.task_rows, self.committed, self.progress = latest, fetch, batch_rows, task_rows, committed, progress
        self.at = None  # where the next batch starts, if known

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        total = self.latest()
        if self.at is None:  # just (re)started: Spark does not say where the query stands
            self.at = self.progress.read() if self.progress else total
        self.at = max(self.at, min(total, self.at + self.batch_rows))
        return {"row": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, last = start["row"], end["row"]
        if last < first:
            raise ValueError(f"the source has {last} rows, {first} were read before")
        self.at = max(self.at or 0, last)  # after a restart the checkpoint is ahead
        return [_Range(i, min(last, i + self.task_rows)) for i in range(first, last, self.task_rows)]

    def read(self, partition: _Range) -> Iterator:
        return iter(self.fetch(partition.start, partition.end))

    def commit(self, end: dict) -> None:
        if self.progress:
            self.progress.write(end["row"])
        if self.committed:
            self.committed(end["row"])


def user_stream(spark: SparkSession, name: str, schema: str, latest: Callable[[], int], fetch: Callable[[int, int], Iterable],
                batch_rows: int = BATCH_ROWS, task_rows: int = TASK_ROWS, committed: Callable[[int], None] | None = None,
                progress: str | None = None) -> DataFrame:
    """A stream of rows numbered from 0 that the user's functions give.

    ``fetch(start, end)`` runs in tasks and must give the same rows whenever it is
    asked (tuples, or Arrow batches of ``schema``). ``committed(n)`` is
    called on the driver when rows before ``n`` are no longer needed.
    ``progress`` names a file, one a query, that keeps batches bounded across restarts; without it
    the first batch after a start takes all rows there are.
    """
    for f in (latest, fetch, committed):
        module = sys.modules.get(getattr(f, "__module__", None) or "")
        if module is not None and module.__name__ not in ("__main__", "builtins"):
            cloudpickle.register_pickle_by_value(module)

    class UserSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Reader(latest, fetch, batch_rows, task_rows, committed, _Progress(progress) if progress else None)

    spark.dataSource.register(UserSource)
    return spark.readStream.format(name).load()


@dataclass(frozen=True)
class Replay:
    """A written table as a source: its files' rows, file by file, numbered from 0.

    The footers say which rows a file and its row groups hold, so a task
    reads the row groups of its own rows only.
    """

    path: str
    columns: tuple[str, ...]

    def _files(self):
        system, root = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        found = system.get_file_info(pafs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == pafs.FileType.Directory else [system.get_file_info(root)]
        return system, sorted(f.path for f in found if f.type == pafs.FileType.File and not os.path.basename(f.path).startswith(("_", ".")))

    def latest(self) -> int:
        system, files = self._files()
        return sum(pq.read_metadata(f, filesystem=system).num_rows for f in files)

    def fetch(self, start: int, end: int) -> Iterator[pa.RecordBatch]:
        system, files = self._files()
        before = 0
        for f in files:
            meta = pq.read_metadata(f, filesystem=system)
            if before < end and before + meta.num_rows > start:
                with pq.ParquetFile(system.open_input_file(f)) as file:
                    at = before
                    for g in range(meta.num_row_groups):
                        n = meta.row_group(g).num_rows
                        if at < end and at + n > start:
                            part = file.read_row_group(g, columns=list(self.columns)).select(list(self.columns))
                            yield from part.slice(max(0, start - at), min(end, at + n) - max(start, at)).to_batches()
                        at += n
            before += meta.num_rows


def replay_stream(spark: SparkSession, path: str, name: str = "tidemark_replay", batch_rows: int = BATCH_ROWS, task_rows: int = TASK_ROWS,
                  progress: str | None = None) -> DataFrame:
    """A Parquet table as a user-defined stream source, whole rows in file order, ``batch_rows`` a micro-batch."""
    schema = spark.read.parquet(path).schema
    replay = Replay(path, tuple(schema.names))
    return user_stream(spark, name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), replay.latest, replay.fetch,
                       batch_rows, task_rows, progress=progress)


# ------------------------------------------------------------ sinks

class Sink:
    """A user's sink. ``open``, ``write`` and ``close`` run in tasks, ``commit`` and ``abort`` on the driver."""

    def open(self) -> object:
        """A connection for one task."""
        return None

    def write(self, connection: object, rows: pa.RecordBatch) -> None:
        raise NotImplementedError

    def finish(self, connection: object) -> object:
        """What the task tells the driver once all its rows are written."""
        return None

    def close(self, connection: object) -> None:
        """Called whether the task succeeded or failed."""

    def commit(self, told: list, batch_id: int) -> None:
        """Make a batch visible; may be called again for a batch that was committed."""

    def abort(self, told: list, batch_id: int) -> None:
        """Some task failed for good."""


@dataclass
class _Told(WriterCommitMessage):
    value: object


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, sink: Sink):
        self.sink = sink

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        connection = self.sink.open()
        try:
            for batch in iterator:
                self.sink.write(connection, batch)
            return _Told(self.sink.finish(connection))
        finally:
            self.sink.close(connection)

    def commit(self, messages: list, batchId: int) -> None:
        self.sink.commit([m.value for m in messages if m is not None], batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.sink.abort([m.value for m in messages if m is not None], batchId)


def start_user_sink(df: DataFrame, sink: Sink, checkpoint: str, name: str = "tidemark_sink", available_now: bool = True):
    """Write a stream to a user's sink; with ``available_now`` wait until the input is drained."""
    module = sys.modules.get(type(sink).__module__)
    if module is not None and module.__name__ != "__main__":
        cloudpickle.register_pickle_by_value(module)

    class UserSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "value string"

        def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
            return _Writer(sink)

    df.sparkSession.dataSource.register(UserSink)
    w = df.writeStream.format(name).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


class TableSink(Sink):
    """A Parquet table at ``path`` (a folder that all tasks reach) to which each batch is added once.

    A task writes one file under a name of its own; the driver then writes the
    batch's manifest, and ``read`` takes the files that manifests name. A
    batch that was committed and is run again replaces its manifest by one of equal rows.
    """

    def __init__(self, path: str):
        self.path = path

    def _system(self):
        return pafs.FileSystem.from_uri(self.path) if ":/" in self.path else (pafs.LocalFileSystem(), self.path)

    def open(self):
        system, root = self._system()
        system.create_dir(f"{root}/files", recursive=True)
        return {"system": system, "file": f"files/{uuid.uuid4().hex}.parquet", "root": root, "writer": None}

    def write(self, connection, rows):
        if connection["writer"] is None:
            connection["writer"] = pq.ParquetWriter(f"{connection['root']}/{connection['file']}", rows.schema, filesystem=connection["system"])
        connection["writer"].write_batch(rows)

    def finish(self, connection):
        if connection["writer"] is None:
            return None
        connection["writer"].close()
        connection["writer"] = None
        return connection["file"]

    def close(self, connection):
        if connection["writer"] is not None:  # the task failed
            connection["writer"].close()
            connection["system"].delete_file(f"{connection['root']}/{connection['file']}")

    def commit(self, told, batch_id):
        system, root = self._system()
        system.create_dir(f"{root}/manifest", recursive=True)
        with system.open_output_stream(f"{root}/manifest/{batch_id}.draft") as out:
            out.write(json.dumps([f for f in told if f]).encode())
        system.move(f"{root}/manifest/{batch_id}.draft", f"{root}/manifest/{batch_id}.json")

    def abort(self, told, batch_id):
        system, root = self._system()
        for f in told:
            if f:
                system.delete_file(f"{root}/{f}")

    def files(self) -> list[str]:
        """Files of the committed batches."""
        system, root = self._system()
        out = []
        for info in sorted(system.get_file_info(pafs.FileSelector(f"{root}/manifest", allow_not_found=True)), key=lambda f: f.path):
            if info.path.endswith(".json"):
                with system.open_input_stream(info.path) as f:
                    out += [f"{self.path}/{x}" for x in json.loads(f.read())]
        return out

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        files = self.files()
        return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
