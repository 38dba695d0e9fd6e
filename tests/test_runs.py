"""Keyed tables as levelled runs: replay, crashes, deletions, bounded reads, readers beside a writer."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fixture_rows import rows
from tidemark.sinks import writers
from tidemark.sinks.runs import KeyedTable, Runs


def _path():
    return f"{tempfile.mkdtemp(prefix='tidemark-runs-')}/t"


def _batch(spark, i):
    return spark.createDataFrame([(f"k{i % 7}", i), (f"n{i}", i), (None, i)], "key string, value int").coalesce(1)


def _expected(n):
    out = {}
    for i in range(n):
        out |= {f"k{i % 7}": i, f"n{i}": i, None: i}
    return out


def test_many_batches_leave_few_runs(spark):
    """30 batches: every key's last row, and never more than (fanout - 1) runs a level."""
    path, n = _path(), 30
    table = KeyedTable(spark, path, fanout=3)
    for i in range(n):
        assert table.upsert(_batch(spark, i), i)
    live = table.runs.live()
    levels = [r.level for r in live]
    assert max(levels) == 3 and all(levels.count(x) <= 2 for x in set(levels))
    assert sorted((r.first, r.last) for r in live)[0][0] == 0 and max(r.last for r in live) == n - 1
    read = {os.path.dirname(f).rsplit("/", 1)[-1] for f in table.read().inputFiles()}
    assert read == {r.name for r in live}  # a read touches live runs only
    assert len(os.listdir(f"{path}/runs")) <= len(live) + 3 * 3 and len([f for f in os.listdir(f"{path}/manifest") if f.endswith(".json")]) == 3
    assert {r.key: r.value for r in table.read().collect()} == _expected(n)


def test_replay_is_skipped(spark):
    table = KeyedTable(spark, _path(), fanout=2)
    for i in range(5):
        assert table.upsert(_batch(spark, i), i)
        assert not table.upsert(_batch(spark, i + 100), i)
    assert {r.key: r.value for r in table.read().collect()} == _expected(5)


@pytest.mark.parametrize("crash", ["before the first manifest", "before a merge's manifest", "in vacuum"])
def test_crash_leaves_the_batch_or_the_state_before(spark, crash, monkeypatch):
    path = _path()
    table = KeyedTable(spark, path, fanout=2)
    table.upsert(_batch(spark, 0), 0)
    calls = []

    def publish(self, *args, real=Runs._publish):
        calls.append(args)
        if (crash == "before the first manifest" and len(calls) == 1) or (crash == "before a merge's manifest" and len(calls) == 2):
            raise OSError("lost")
        real(self, *args)

    def vacuum(self):
        raise OSError("lost")

    monkeypatch.setattr(Runs, "_publish", publish)
    if crash == "in vacuum":
        monkeypatch.setattr(Runs, "vacuum", vacuum)
    with pytest.raises(OSError):
        table.upsert(_batch(spark, 1), 1)
    monkeypatch.undo()
    again = KeyedTable(spark, path, fanout=2)
    n = 1 if crash == "before the first manifest" else 2
    assert {r.key: r.value for r in again.read().collect()} == _expected(n)
    assert again.upsert(_batch(spark, 1), 1) == (n == 1)  # the replay
    again.runs.compact()
    assert {r.key: r.value for r in again.read().collect()} == _expected(2)
    assert [r.level for r in again.runs.live()] == [1]
    again.upsert(_batch(spark, 2), 2)
    assert {r.key: r.value for r in again.read().collect()} == _expected(3)


def test_deletions_hide_and_settle(spark):
    """A retraction deletes its key; a merge that reaches the oldest run forgets the deletion."""
    table = KeyedTable(spark, _path(), fanout=2)
    table.upsert(spark.createDataFrame([("a", 1), ("b", 2)], "key string, value int"), 0)
    gone = spark.createDataFrame([("a", None, False), ("c", 3, True)], "key string, value int, is_add boolean")
    table.upsert(gone.select("key", "value"), 1, gone=F.col("value").isNull())
    assert rows(table.read()) == [("b", 2), ("c", 3)]
    assert table.runs.rows_of(table.runs.live()).count() == 2
    table.upsert(spark.createDataFrame([("a", 9)], "key string, value int"), 2)
    assert rows(table.read()) == [("a", 9), ("b", 2), ("c", 3)]


def test_a_reader_keeps_its_runs_while_batches_arrive(spark):
    path = _path()
    table = KeyedTable(spark, path, fanout=2, keep=6)
    table.upsert(_batch(spark, 0), 0)
    seen = table.read()
    for i in range(1, 4):
        table.upsert(_batch(spark, i), i)
    assert {r.key: r.value for r in seen.collect()} == _expected(1)


def test_empty_batches_and_missing_tables(spark):
    path = _path()
    assert KeyedTable(spark, path).read() is None
    with pytest.raises(FileNotFoundError):
        writers.read_upserted(spark, path)
    table = KeyedTable(spark, path, fanout=2)
    for i in range(3):
        table.upsert(_batch(spark, 0).where("false"), i)
    assert table.read().columns == ["key", "value"] and table.read().count() == 0
    with pytest.raises(ValueError):
        KeyedTable(spark, path, fanout=1)


def test_runs_of_sums(spark):
    """Any merge rule that can be applied in steps: counts per key."""
    runs = Runs(spark, _path(), lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), ["k"], fanout=3)
    for i in range(10):
        runs.add(spark.createDataFrame([("a", 1), (f"b{i}", 2)], "k string, n bigint"), i)
    got = dict(rows(runs.read()))
    assert got.pop("a") == 10 and got == {f"b{i}": 2 for i in range(10)}
