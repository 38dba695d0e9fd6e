"""Tables kept as levelled runs: they grow by batches and stay cheap to read.

A batch is written once, as a run (a folder of Parquet files sorted by key).
``FANOUT`` runs of a level are merged into one of the next level, so N batches
leave at most ``(FANOUT - 1) * log(N)`` live runs, and a row is rewritten once
a level. A manifest names the live runs. A change writes its files first, then
a manifest of the next number under its final name; until that rename the
table is as before, so a crash leaves either the batch or the former state.
A batch id that was applied is skipped, so a replayed batch counts once.

One writer at a time, any number of readers. Files that no longer belong to
the last ``KEEP`` manifests are deleted; a reader that is slower than
that many batches plans its read again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FANOUT = 8
#: Manifests whose files are kept for readers that planned by them.
KEEP = 3


class Files:
    """The file operations that a manifest needs, through Hadoop, so that any shared folder will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._sc = path.rstrip("/"), spark.sparkContext
        self._fs = self._at("").getFileSystem(self._sc._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write under another name, then rename: the file is there whole or not at all. Fails if it exists."""
        draft = self._at(f"{name}.draft")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        jvm = self._sc._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._sc._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        context.rename(draft, self._at(name), self._sc._gateway.new_array(kind, 0))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


@dataclass(frozen=True)
class Run:
    """A live run: its folder, level, and the batches it covers."""

    name: str
    level: int
    first: int
    last: int


class Runs:
    """A table at ``path`` as levelled runs.

    ``merge`` turns the union of several runs into the rows of one (sums of
    counts, the last row of each key, ...). It must give the same
    table whether runs are merged at once or in steps. ``sort`` names the
    columns that the files of a run are sorted by. ``settle`` drops what
    only hides older rows (deletions) from a run that has none before it.
    """

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], sort: Sequence[str],
                 fanout: int = FANOUT, keep: int = KEEP, settle: Callable[[DataFrame], DataFrame] | None = None):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.path, self.merge, self.sort = spark, path.rstrip("/"), merge, list(sort)
        self.fanout, self.keep, self.settle = fanout, max(1, keep), settle or (lambda rows: rows)
        self._files = Files(spark, self.path)

    # ------------------------------------------------------------ manifest

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._files.names("manifest") if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, version: int) -> tuple[int, list[Run]]:
        found = json.loads(self._files.read(f"manifest/{version}.json"))
        return found["batch"], [Run(**r) for r in found["runs"]]

    def state(self) -> tuple[int, int, list[Run]]:
        """(manifest number, last batch applied, live runs); (0, -1, []) for a table that was never written."""
        versions = self._versions()
        return (versions[-1], *self._load(versions[-1])) if versions else (0, -1, [])

    def live(self) -> list[Run]:
        return self.state()[2]

    def _publish(self, version: int, batch: int, runs: list[Run]) -> None:
        self._files.publish(f"manifest/{version}.json", json.dumps({"batch": batch, "runs": [asdict(r) for r in runs]}))

    # ------------------------------------------------------------ rows

    def _write(self, rows: DataFrame, run: Run) -> None:
        rows.sortWithinPartitions(*self.sort).write.mode("overwrite").parquet(f"{self.path}/runs/{run.name}")

    def rows_of(self, runs: Sequence[Run]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/runs/{r.name}" for r in runs])

    def read(self) -> DataFrame | None:
        """The merged table, None if nothing was ever written. Reads the live runs only."""
        runs = self.live()
        return self.merge(self.rows_of(runs)) if runs else None

    def add(self, rows: DataFrame, batch_id: int) -> bool:
        """Add a batch as a run of its own, then merge full levels. False if the batch was applied before."""
        version, batch, runs = self.state()
        if batch_id <= batch:
            return False
        run = Run(f"0-{batch_id}-{batch_id}", 0, batch_id, batch_id)
        self._write(rows, run)
        runs = [*runs, run]
        self._publish(version + 1, batch_id, runs)
        self._compact(version + 1, batch_id, runs)
        return True

    def _compact(self, version: int, batch: int, runs: list[Run]) -> None:
        level = 0
        while level <= max(r.level for r in runs):
            full = [r for r in runs if r.level == level]
            if len(full) >= self.fanout:
                first, last = min(r.first for r in full), max(r.last for r in full)
                run = Run(f"{level + 1}-{first}-{last}", level + 1, first, last)
                merged = self.merge(self.rows_of(full))
                self._write(self.settle(merged) if first == min(r.first for r in runs) else merged, run)
                runs = [run if r is full[0] else r for r in runs if r is full[0] or r not in full]
                version += 1
                self._publish(version, batch, runs)
            level += 1
        self.vacuum()

    def compact(self) -> None:
        """Merge levels that are full: what an interrupted ``add`` left undone. ``add`` does it by itself."""
        version, batch, runs = self.state()
        if runs:
            self._compact(version, batch, runs)

    def vacuum(self) -> None:
        """Delete manifests before the last ``keep`` and the runs that none of those names (also half-written ones)."""
        versions = self._versions()
        kept = versions[-self.keep:]
        named = {r.name for v in kept for r in self._load(v)[1]}
        for name in self._files.names("runs"):
            if name not in named:
                self._files.delete(f"runs/{name}")
        for v in versions[:-self.keep]:
            self._files.delete(f"manifest/{v}.json")


# ---------------------------------------------------------------- keyed tables

BATCH, GONE = "_batch", "_gone"


def last_of_each(key: str) -> Callable[[DataFrame], DataFrame]:
    """Merge rule of keyed tables: the row of the last batch of each key; each task keeps one row a key before the shuffle."""
    def merge(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(key).orderBy(F.col(BATCH).desc())
        return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    return merge


class KeyedTable:
    """A table with one row per key (a NULL key is a key), upserted by batches.

    A batch holds each key once. Rows for which ``gone`` is true delete
    their key (the retractions of a changelog).
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "key", fanout: int = FANOUT, keep: int = KEEP):
        self.runs = Runs(spark, path, last_of_each(key), [key], fanout, keep, settle=lambda rows: rows.where(~F.col(GONE)))

    def upsert(self, batch: DataFrame, batch_id: int, gone: Column | None = None) -> bool:
        marked = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
        return self.runs.add(batch.withColumns({BATCH: F.lit(batch_id).cast("bigint"), GONE: marked}), batch_id)

    def read(self) -> DataFrame | None:
        """The current rows, None if nothing was ever written."""
        rows = self.runs.read()
        return None if rows is None else rows.where(~F.col(GONE)).drop(BATCH, GONE)
