"""User aggregates on streams: changelogs, windows with lateness and firings, processing-time windows, against the table forms."""
import os
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fixture_rows import rows
from tidemark.functions import aggregates as ag
from tidemark.operators import rolling, watermark
from tidemark.sources import readings as rd
from tidemark.streaming import grouped, runner, stateful

LINES = ["a,100,5.0", "b,103,1.0", "a,96,7.0", "a,131,nan", "b,128,2.5", "a,97,9.0", "a,112,nan", "b,160,2.5", "a,101,3.0", "b,149,-inf",
         "a,190,1.0", "a,99,4.0", "b,260,0.5", "a,205,8.0"]


@pytest.fixture(scope="module")
def folder():
    """One line a file: a micro-batch each."""
    d = tempfile.mkdtemp(prefix="tidemark-grouped-")
    for i, line in enumerate(LINES):
        path = os.path.join(d, f"{i:03d}.txt")
        with open(path, "w") as f:
            f.write(f"{line},{i}\n")
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))
    return d


@pytest.fixture(scope="module")
def table(spark):
    lines = spark.createDataFrame([(x, i) for i, x in enumerate(LINES)], "value string, seq bigint")
    return rd.as_readings(rd.parse_reading(lines))


def _drain(df, name, mode="append", per=1):
    q = runner.run(df, name, tempfile.mkdtemp(prefix="tidemark-ck-"), mode)
    return df.sparkSession.table(name), q


def _text(df, *cols):
    return sorted(str(tuple(r[c] for c in cols)) for r in df.collect())


def test_changelog_of_an_average_with_nan(spark, folder, table):
    """Equal to the table form, NaN averages included: an average that stays NaN changes nothing."""
    s = runner.readings_stream(spark, folder, files_per_trigger=5)
    got, _ = _drain(grouped.changelog_stream(s, ["id"], ag.AvgTemp(), ["temp"], same=grouped.nearly()), "log_avg")
    cols = ("id", "seq", "is_add", "change", "avg_temp")
    assert _text(got, *cols) == _text(rolling.retract_avg(table), *cols)
    assert got.where("isnan(avg_temp) and is_add").count() == 1 and got.where("avg_temp < -1e300 and is_add").count() == 1
    own = stateful.apply(runner.readings_stream(spark, folder, files_per_trigger=5), "id", stateful.RetractAvg(), stateful.RetractAvg.SCHEMA)
    nan_as_null = got.withColumn("avg_temp", F.when(~F.isnan("avg_temp"), F.col("avg_temp")))  # frames cannot tell
    assert _text(_drain(own, "log_avg_own")[0], *cols) == _text(nan_as_null, *cols)


def test_changelog_of_a_table_aggregate(spark, folder, table):
    s = runner.readings_stream(spark, folder, files_per_trigger=4)
    got, _ = _drain(grouped.changelog_stream(s, ["id"], ag.Top2Temp(), ["temp"]), "log_top")
    cols = ("id", "seq", "is_add", "change", "temp", "rank")
    assert _text(got, *cols) == _text(rolling.top2_retract(table), *cols)


def test_changelog_of_a_windowed_count_drops_its_state(spark, folder, table):
    s = runner.readings_stream(spark, folder, files_per_trigger=1)
    out = grouped.window_changelog_stream(s, ["id"], grouped.Count(), ["temp"], "30 seconds", "1000 seconds")
    got, _ = _drain(out, "log_win")
    final = {}
    for r in sorted(got.collect(), key=lambda r: (r.seq, r.change)):
        if r.is_add:
            final[r.id, r.window_end_ms] = r.cnt
        else:
            assert final[r.id, r.window_end_ms] == r.cnt
    want = table.groupBy("id", F.window("ts", "30 seconds")["end"].alias("e")).count().select(
        "id", (F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("e"))).alias("e"), "count")
    assert final == {(r.id, r.e): r["count"] for r in want.collect()}
    out = grouped.window_changelog_stream(s, ["id"], grouped.Count(), ["temp"], "30 seconds", "5 seconds")
    _, q = _drain(out, "log_win_short")
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4  # only windows that the watermark has not passed


def test_lateness_fires_at_the_end_and_for_each_later_row(spark, folder, table):
    """Batch for batch as the table form has it, except for windows that the watermark never reached."""
    size, slide, delay, late = 30, 15, 5, 40
    s = runner.readings_stream(spark, folder, files_per_trigger=1)
    got, q = _drain(grouped.lateness_stream(s, size, slide, delay, late), "firings")
    want = watermark.window_firings(table.withColumn("arrival", F.col("seq")), size, slide, delay, late, order=("arrival", "seq"))
    reached = (260 - delay) * 1000  # the last watermark
    want = want.where((F.col("window_start_ms") + size * 1000 - 1 <= reached) | F.col("late"))
    cols = ("id", "window_start_ms", "cnt", "late")
    assert _text(got, *cols) == _text(want, *cols)
    assert got.where("late").count() >= 3
    open_windows = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert open_windows <= 12  # those of the last 30 + 40 seconds, with their timers


class _Handle:
    """State and timers of one key, for driving a processor by a clock."""

    def __init__(self):
        self.timers, self.state = set(), {}

    def registerTimer(self, t):
        self.timers.add(t)

    def getMapState(self, *_):
        s = self.state
        return SimpleNamespace(containsKey=lambda k: k in s, getValue=lambda k: s[k], updateValue=s.__setitem__, removeKey=lambda k: s.pop(k))


def test_processing_time_windows_fire_once_by_a_driven_clock():
    import pandas as pd
    p = grouped.ProcessingTimeWindows(grouped.Count(), ["id"], ["seq"], 10_000)
    handle = _Handle()
    p.init(handle)
    fired = []
    for now, n in ((1_000, 2), (9_999, 1), (10_000, 4), (35_000, 1), (50_000, 0)):
        clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda now=now: now)
        if n:
            list(p.handleInputRows(("a",), iter([pd.DataFrame({"seq": range(n)})]), clock))
        for t in sorted(t for t in handle.timers if t < now):
            handle.timers.remove(t)
            fired += [tuple(r)[:-1] for f in p.handleExpiredTimer(("a",), clock, SimpleNamespace(getExpiryTimeInMs=lambda t=t: t)) for r in f.itertuples(index=False)]
    assert fired == [("a", 0, 3), ("a", 10_000, 4), ("a", 30_000, 1)]
    assert not handle.timers and not handle.state


def test_processing_time_windows_on_a_stream(spark, folder):
    import time
    s = runner.readings_stream(spark, folder, files_per_trigger=20)
    q = (grouped.processing_time_stream(s, 2).writeStream.format("memory").queryName("proc").outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="tidemark-ck-")).trigger(processingTime="500 milliseconds").start())
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("proc").count() < 2:
            time.sleep(1)
        assert rows(spark.table("proc").groupBy("id").agg(F.sum("cnt").alias("n"), F.count("*").alias("w"))) == [("a", 9, 1), ("b", 5, 1)]
    finally:
        q.stop()
