"""Stream forms agree with the table forms once the stream is drained.

The sensor fixture is written as files that arrive one per micro-batch;
lines carry ``seq`` as a fourth field. Watermark-driven outputs get a
far-future flush row so every window and timer closes.
"""
import os
import sqlite3
import tempfile

import pytest
from pyspark.sql import functions as F

from fixture_rows import SENSOR_LINES, rows
from tidemark.operators import alerts, rolling, windows
from tidemark.functions import udfs
from tidemark.sinks import writers
from tidemark.sources import readings as rd
from tidemark.streaming import runner, stateful

FLUSH = "zflush,1900000000,0.0"


def _write_batches(lines, per_file, start_seq=0):
    d = tempfile.mkdtemp(prefix="tidemark-stream-")
    for i in range(0, len(lines), per_file):
        p = os.path.join(d, f"part-{i:04d}.txt")
        with open(p, "w") as f:
            for j, line in enumerate(lines[i:i + per_file]):
                f.write(f"{line},{start_seq + i + j}\n")
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))  # the file source orders by mtime
    return d


def _ckpt():
    return tempfile.mkdtemp(prefix="tidemark-ckpt-")


@pytest.fixture()
def stream_dir():
    return _write_batches(SENSOR_LINES, 3)


def _drain(spark, df, name, mode="append"):
    runner.run(df, name, _ckpt(), mode=mode)
    return spark.table(name)


def test_jump_stream(spark, sensor, stream_dir):
    s = runner.readings_stream(spark, stream_dir)
    out = stateful.apply(s, "id", stateful.TempJump(10.0), stateful.TempJump.SCHEMA)
    got = rows(_drain(spark, out, "jumps"), "id", "last_temp", "temp")
    assert got == rows(alerts.temp_jump(sensor, 10.0), "id", "last_temp", "temp")
    out0 = stateful.apply(s, "id", stateful.TempJump(10.0, seed_zero=True), stateful.TempJump.SCHEMA)
    got0 = rows(_drain(spark, out0, "jumps0"), "id", "last_temp", "temp")
    assert got0 == rows(alerts.temp_jump(sensor, 10.0, seed_zero=True), "id", "last_temp", "temp")


def test_row_frames_stream(spark, sensor, stream_dir):
    s = runner.readings_stream(spark, stream_dir)
    out = stateful.apply(s, "id", stateful.LastRows(3), stateful.LastRows.SCHEMA)
    got = _drain(spark, out, "over3")
    table = windows.over_rows(sensor, 2)
    assert rows(got, "seq", "cnt", "avg_temp") == rows(table, "seq", "cnt", "avg_temp")
    out10 = stateful.apply(s, "id", stateful.LastRows(10), stateful.LastRows.SCHEMA)
    cw = windows.count_window(sensor, 10)
    assert rows(_drain(spark, out10, "cw10"), "seq", "cnt", "max_timestamp", "min_temp") == \
        rows(cw, "seq", "cnt", "max_timestamp", "min_temp")


def test_rising_alarm_event_time_stream(spark, sensor):
    d = _write_batches(SENSOR_LINES + [FLUSH], 1)
    s = runner.readings_stream(spark, d).withWatermark("ts", "1 second")
    out = stateful.apply(s, "id", stateful.RisingAlarm(10, "EventTime"), stateful.RisingAlarm.SCHEMA,
                         time_mode="EventTime")
    got = _drain(spark, out, "alarms")
    got = sorted((r.id, r.alarm_ms) for r in got.collect() if r.id != "zflush")
    table = alerts.rising_alarm(sensor, 10).select("id", F.unix_millis(F.col("alarm_ts").cast("timestamp")).alias("ms"))
    assert got == rows(table, "id", "ms")


def test_top2_and_retract_stream(spark, sensor, stream_dir):
    s = runner.readings_stream(spark, stream_dir)
    top = _drain(spark, stateful.apply(s, "id", stateful.Top2(), stateful.Top2.SCHEMA, "update"), "top2s", "update")
    final = {}
    for r in top.collect():  # later batches overwrite earlier ones per (id, rank)
        final[(r.id, r.rank)] = r.temp
    assert sorted((k[0], v, k[1]) for k, v in final.items()) == rows(udfs.top2(sensor), "id", "temp", "rank")
    ret = _drain(spark, stateful.apply(s, "id", stateful.RetractAvg(), stateful.RetractAvg.SCHEMA), "retract")
    assert rows(ret, "seq", "is_add", "avg_temp") == rows(rolling.retract_avg(sensor), "seq", "is_add", "avg_temp")


def test_state_tour(spark, stream_dir):
    s = runner.readings_stream(spark, stream_dir)
    out = _drain(spark, stateful.apply(s, "id", stateful.StateTour(), stateful.StateTour.SCHEMA, "update"),
                 "tour", "update")
    last = {}
    for r in out.collect():
        if r.id not in last or r.list_len > last[r.id].list_len:
            last[r.id] = r
    assert last["sensor1"].list_len == 3 and last["sensor4"].list_len == 5
    assert (last["sensor4"].max_timestamp, last["sensor4"].min_temp) == (1547740199, 35.6)
    assert last["sensor4"].map_size == 1 and last["sensor1"].map_size == 3
    assert (last["sensor1"].max_timestamp, last["sensor1"].min_temp) == (1547729799, 0.89)


def test_tumble_and_session_stream(spark, sensor):
    d = _write_batches(SENSOR_LINES + [FLUSH], 3)
    s = runner.readings_stream(spark, d)
    got = _drain(spark, runner.tumble_stream(s, "10 seconds", "1 second"), "tumble_s")
    table = windows.tumble(sensor, "10 seconds")
    assert rows(got.where("id <> 'zflush'")) == rows(table.select(*got.columns))
    ses = _drain(spark, runner.session_stream(s, 60, "5 seconds"), "session_s")
    assert rows(ses.where("id <> 'zflush'")) == rows(windows.session_count(sensor, 60).select(*ses.columns))


def test_sliding_stream_unflushed_emits_closed_windows_only(spark):
    d = _write_batches(SENSOR_LINES, 3)
    s = runner.readings_stream(spark, d)
    got = _drain(spark, runner.sliding_count_stream(s, "15 seconds", "5 seconds", "5 seconds"), "slide_s")
    assert got.count() == 9 and got.where("id = 'sensor4'").count() == 0


def test_running_count_restart_continues(spark):
    d = _write_batches(SENSOR_LINES[:4], 2)
    ck = _ckpt()
    s = runner.readings_stream(spark, d)
    runner.run(runner.running_count_stream(s), "counts_a", ck, mode="complete")
    assert dict(rows(spark.table("counts_a"))) == {"sensor1": 3, "sensor4": 1}
    with open(os.path.join(d, "part-9999.txt"), "w") as f:
        for i, line in enumerate(SENSOR_LINES[4:]):
            f.write(f"{line},{4 + i}\n")
    os.utime(os.path.join(d, "part-9999.txt"), (1_700_000_000, 1_700_000_000))
    runner.run(runner.running_count_stream(runner.readings_stream(spark, d)), "counts_b", ck, mode="complete")
    assert dict(rows(spark.table("counts_b"))) == {"sensor1": 3, "sensor4": 5}


def test_late_router_stream(spark):
    lines = ["k,1000,1.0", "k,1100,1.0", "k,1020,1.0", "k,1025,1.0", "k,1030,1.0"]
    d = _write_batches(lines, 1)
    base = tempfile.mkdtemp(prefix="tidemark-late-")
    router = runner.LateRouter(f"{base}/state", f"{base}/on_time", f"{base}/late", 15, 5, 5, 60)
    runner.run(runner.readings_stream(spark, d), "late", _ckpt(), foreach_batch=router)
    assert [r.seq for r in spark.read.parquet(f"{base}/late").collect()] == [2]
    assert sorted(r.seq for r in spark.read.parquet(f"{base}/on_time").collect()) == [0, 1, 3, 4]


def test_file_sinks_and_upsert(spark, sensor, stream_dir):
    base = tempfile.mkdtemp(prefix="tidemark-sink-")
    s = runner.readings_stream(spark, stream_dir)
    # row-format text sink with the record payload
    runner.run(s.select(writers.record_text().alias("value")), "txt", _ckpt(), fmt="text", path=f"{base}/text")
    assert spark.read.text(f"{base}/text").count() == 8
    # grouped table into an append-only CSV sink: complete result per batch
    counts = writers.insert_by_position(rolling.group_count(s), ["id", "cnt"])
    runner.run(counts, "csv", _ckpt(), mode="complete", foreach_batch=writers.foreach_batch_overwrite(f"{base}/csv"))
    assert rows(spark.read.schema("id string, cnt bigint").csv(f"{base}/csv")) == [("sensor1", 3), ("sensor4", 5)]
    # keyed upsert (the document / hash sinks): last writer per key wins
    runner.run(s, "ups", _ckpt(), foreach_batch=writers.foreach_batch_upsert(f"{base}/upsert", "id", "temp"))
    assert rows(writers.read_upserted(spark, f"{base}/upsert")) == [("sensor1", 78.6), ("sensor4", 55.0)]


def test_database_upsert(spark, sensor, tmp_path):
    """Update, else insert, one write per key; a second run (a retry) changes nothing."""
    db = str(tmp_path / "t.db")
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE temp (sensor TEXT, tempu REAL)")
    con.execute("INSERT INTO temp VALUES ('sensor1', 1.0), ('other', 2.0)")
    con.commit()
    for _ in range(2):
        writers.dbapi_upsert(sensor, lambda: sqlite3.connect(db, timeout=60), "temp", "id", "temp")
        assert sorted(con.execute("SELECT * FROM temp")) == [("other", 2.0), ("sensor1", 78.6), ("sensor4", 55.0)]
    con.close()


def test_three_field_lines_as_a_stream(spark, sensor):
    d = tempfile.mkdtemp(prefix="tidemark-three-")
    for i in range(0, len(SENSOR_LINES), 3):
        with open(os.path.join(d, f"part-{i:04d}.txt"), "w") as f:
            f.write("\n".join(SENSOR_LINES[i:i + 3]) + "\n")
        os.utime(f.name, (1_600_000_000 + i, 1_600_000_000 + i))
    out = stateful.apply(runner.readings_stream(spark, d), "id", stateful.TempJump(10.0), stateful.TempJump.SCHEMA)
    got = rows(_drain(spark, out, "jumps3"), "id", "last_temp", "temp")
    assert got == rows(alerts.temp_jump(sensor, 10.0), "id", "last_temp", "temp")


def test_disordered_stream_does_not_depend_on_batch_cuts(spark):
    """Arrival order decides, so two cuts of the same lines and the table form agree."""
    lines = ["k,100,0.0", "k,50,50.0", "k,200,5.0", "k,10,90.0", "k,300,88.0", "k,20,1.0"]
    table = rd.as_readings(rd.from_rows(spark, [(p[0], int(p[1]), float(p[2])) for p in (x.split(",") for x in lines)]))
    for n, per in enumerate((1, 2, 6)):
        s = runner.readings_stream(spark, _write_batches(lines, per))
        jumps = stateful.apply(s, "id", stateful.TempJump(10.0), stateful.TempJump.SCHEMA)
        assert rows(_drain(spark, jumps, f"cut_j{n}"), "last_temp", "temp") == rows(alerts.temp_jump(table, 10.0), "last_temp", "temp")
        frames = stateful.apply(s, "id", stateful.LastRows(3), stateful.LastRows.SCHEMA)
        assert rows(_drain(spark, frames, f"cut_f{n}"), "seq", "cnt", "min_temp") == \
            rows(windows.count_window(table, 3).withColumnRenamed("min_temp", "m").select("seq", "cnt", "m"), "seq", "cnt", "m")


def test_csv_table_stream(spark):
    d = tempfile.mkdtemp(prefix="tidemark-csv-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("\n".join(SENSOR_LINES) + "\n")
    from tidemark.sources import readings as rd
    t = rd.read_csv_table(spark, d, "id STRING, timestamp BIGINT, temp DOUBLE", name="input_table")
    assert spark.sql("SELECT id, temp FROM input_table WHERE id = 'sensor1'").count() == 3
    st = rd.read_csv_table(spark, d, "id STRING, timestamp BIGINT, temp DOUBLE", stream=True)
    got = _drain(spark, st.select("id", "temp").where("id = 'sensor1'"), "csv_stream")
    assert rows(got) == rows(t.select("id", "temp").where("id = 'sensor1'"))


def test_lateness_counts_stream_match_table(spark):
    lines = ["k,1000,1.0", "k,1100,1.0", "k,1020,1.0", "k,1025,1.0", "k,1030,1.0"]
    d = _write_batches(lines, 1)
    base = tempfile.mkdtemp(prefix="tidemark-lcount-")
    counter = runner.LatenessWindowCounts(f"{base}/state", f"{base}/counts", 15, 5, 5, 60)
    runner.run(runner.readings_stream(spark, d), "lcount", _ckpt(), foreach_batch=counter)
    got = dict(rows(counter.read_counts(spark), "window_start_ms", "cnt"))
    assert got == {990000: 1, 995000: 1, 1000000: 1, 1090000: 1, 1095000: 1, 1100000: 1,
                   1030000: 1, 1025000: 2}


def test_lateness_counts_stay_few_files(spark):
    """Twenty batches leave few live runs and two running maxima; a replayed batch counts once."""
    base = tempfile.mkdtemp(prefix="tidemark-lruns-")
    counter = runner.LatenessWindowCounts(f"{base}/state", f"{base}/counts", 15, 5, 5, 60)
    assert counter.read_counts(spark).count() == 0
    batches = [spark.createDataFrame([("k", 1000 + 3 * i), (None if i % 2 else "b", 1000)], "id string, t bigint")
               .select("id", F.timestamp_seconds("t").alias("ts")) for i in range(20)]
    for i, b in enumerate(batches):
        counter(b, i)
        if i in (0, 7, 19):
            counter(b, i)
    assert len(counter._runs(spark).live()) == 2 + 20 % 8
    assert sorted(n for n in os.listdir(f"{base}/state") if n.startswith("batch=")) == ["batch=18", "batch=19"]
    want, top = {}, None
    for i in range(20):
        for key, t in (("k", 1000 + 3 * i), (None if i % 2 else "b", 1000)):
            for start in range(t - t % 5, t - t % 5 - 15, -5):
                if top is None or (start + 15) * 1000 - 1 + 60_000 > (top - 5) * 1000:
                    want[key, start * 1000] = want.get((key, start * 1000), 0) + 1
        top = max(1000 + 3 * i, top or 0)
    got = {(r.id, r.window_start_ms): r.cnt for r in counter.read_counts(spark).collect()}
    assert got == want


def test_processing_time_sources(spark):
    from tidemark.sources import readings as rd
    # mixed-type collection, text lines, table replay, processing-time window
    assert [r.value for r in rd.from_mixed(spark, [0, 1.4, 323, "dsds"]).collect()] == ["0", "1.4", "323", "dsds"]
    d = _write_batches(SENSOR_LINES, 4)
    assert rd.read_lines(spark, d).count() == 8
    tbl = tempfile.mkdtemp(prefix="tidemark-replay-")
    rd.from_rows(spark, [("a", 1, 1.0), ("b", 2, 2.0)]).write.mode("overwrite").parquet(tbl)
    rep = rd.replay_table_stream(spark, tbl, rd.SEQ_READING_SCHEMA)
    assert _drain(spark, rep, "replay").count() == 2
    s = runner.readings_stream(spark, d)
    pt = _drain(spark, windows.processing_time_tumble(s, "1 minute"), "proc_tumble", "update")
    assert sum(r.cnt for r in pt.collect()) >= 8


def test_processing_time_alarm_fires(spark):
    import time
    d = _write_batches(SENSOR_LINES, 8)
    s = runner.readings_stream(spark, d)
    out = stateful.apply(s, "id", stateful.RisingAlarm(1, "ProcessingTime"), stateful.RisingAlarm.SCHEMA,
                         time_mode="ProcessingTime")
    q = runner.run(out, "palarm", _ckpt(), available_now=False, processing_time="500 milliseconds")
    try:  # wall-clock timers keep the query busy: poll with a deadline, then stop
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("palarm").where("id = 'sensor1'").count() == 0:
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.table("palarm").collect()
    # sensor1 rises and stays up, so its timer fires (sensor4 may too: batches
    # are wall-clock apart, so its fall can come after its 1 s timer)
    assert "sensor1" in {r.id for r in got} and all(r.message == "温度连续上升1秒" for r in got)


def test_streaming_word_count_drops_empty_words(spark):
    from tidemark.operators import text as tx
    from fixture_rows import HELLO_LINES
    d = tempfile.mkdtemp(prefix="tidemark-words-")
    for i, chunk in enumerate([HELLO_LINES[:3], HELLO_LINES[3:] + ["a  b "]]):
        p = os.path.join(d, f"w{i}.txt")
        with open(p, "w") as f:
            f.write("\n".join(chunk) + "\n")
        os.utime(p, (1_600_000_000 + i,) * 2)
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(d)
    words = tx.tokens(lines, "value", drop_empty=True)
    counts = _drain(spark, runner.running_count_stream(words, key="word"), "wc_stream", "complete")
    got = dict(rows(counts))
    assert got["hello"] == 3 and got["ha"] == 3 and got["a"] == 1 and "" not in got


def test_console_and_line_streams(spark, stream_dir):
    q = writers.console_stream(runner.readings_stream(spark, stream_dir).select("id", "temp"), "result")
    try:
        q.processAllAvailable()
        assert q.exception() is None and q.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming")
    finally:
        q.stop()
    lines = rd.read_lines_stream(spark, stream_dir, 1)
    assert _drain(spark, lines, "lines_s").count() == len(SENSOR_LINES)


def test_labeled_lines(sensor):
    first = writers.labeled(sensor.select("id", "temp").where("seq = 0"), "result").first().line
    assert first == "result> sensor1,0.89"


def test_upsert_batches_replay_and_null_keys(spark):
    t = f"{tempfile.mkdtemp(prefix='tidemark-ups-')}/t"
    first = spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [(None, 7)], "key string, value int")
    second = spark.createDataFrame([("k3", -3), ("new", 1), (None, 8)], "key string, value int")
    writers.upsert_to_path(first, t, 0)
    for _ in range(2):  # the second time is a replay after a crash
        writers.upsert_to_path(second, t, 1)
        got = {r.key: r.value for r in writers.read_upserted(spark, t).collect()}
        assert len(got) == 202 and got["k3"] == -3 and got["new"] == 1 and got["k4"] == 4 and got[None] == 8
    assert writers.read_upserted(spark, t).count() == 202


def test_documents_upserted_by_key(spark, stream_dir):
    base = tempfile.mkdtemp(prefix="tidemark-doc-")
    runner.run(runner.readings_stream(spark, stream_dir), "docup", _ckpt(), foreach_batch=writers.foreach_batch_documents(f"{base}/d"))
    got = dict(rows(writers.read_upserted(spark, f"{base}/d")))
    assert got["sensor4"] == '{"id":"sensor4","temp":"55.0","time":"1547740199"}' and len(got) == 2


def test_reduce_and_min_by_streams(spark, sensor, stream_dir):
    s = runner.readings_stream(spark, stream_dir)
    red = _drain(spark, runner.reduce_stream(s), "reduce_s", "complete")
    assert rows(red) == rows(rolling.reduce_final(sensor).select(*red.columns))
    mb = _drain(spark, runner.min_by_stream(s), "minby_s", "complete")
    assert rows(mb) == rows(rolling.min_by_record(sensor).select(*mb.columns))


def test_grouped_documents_upserted_by_key(spark, stream_dir):
    """A grouped count stream as JSON documents upserted by the grouping key."""
    base = tempfile.mkdtemp(prefix="tidemark-docs-")
    counts = rolling.group_count(runner.readings_stream(spark, stream_dir))
    docs = counts.select(F.col("id").alias("key"),
                         F.to_json(F.struct("id", F.col("count").cast("string").alias("count"))).alias("doc"))

    def upsert(batch, batch_id):
        writers.upsert_to_path(batch, f"{base}/docs", batch_id)
    runner.run(docs, "docs", _ckpt(), mode="update", foreach_batch=upsert)
    got = dict(rows(writers.read_upserted(spark, f"{base}/docs")))
    assert got == {"sensor1": '{"id":"sensor1","count":"3"}', "sensor4": '{"id":"sensor4","count":"5"}'}


def test_late_router_punctuated(spark):
    """Only marker rows advance the watermark (to their time - 1 s): rows of
    other ids far ahead in time do not make anything late."""
    lines = ["m,1000,1.0", "x,5000,1.0", "m,1010,1.0", "k,1002,1.0", "m,1100,1.0", "k,1003,1.0"]
    d = _write_batches(lines, 1)
    base = tempfile.mkdtemp(prefix="tidemark-punct-")
    router = runner.LateRouter(f"{base}/state", f"{base}/on_time", f"{base}/late", 15, 5, 5, 60,
                               marker_id="m", marker_minus_s=1)
    runner.run(runner.readings_stream(spark, d), "punct", _ckpt(), foreach_batch=router)
    # before the last row the watermark is 1099 (m at 1100 - 1): k at 1003 has last
    # window [1000, 1015): 1015 - 0.001 + 60 = 1074.999 <= 1099, so it is late; k at
    # 1002 came when the watermark was 1009: still on time
    assert [r.seq for r in spark.read.parquet(f"{base}/late").collect()] == [5]


def test_session_processor_merges_touching_windows(spark, sensor):
    # gap 900 s: sensor1's rows 900 s apart touch and merge (the reference's
    # rule); Spark's session_window would split them
    d = _write_batches(SENSOR_LINES + [FLUSH], 1)
    s = runner.readings_stream(spark, d).withWatermark("ts", "1 second")
    out = stateful.apply(s, "id", stateful.Sessions(900), stateful.Sessions.SCHEMA, time_mode="EventTime")
    got = sorted((r.id, r.session_start_ms, r.session_end_ms, r.cnt)
                 for r in _drain(spark, out, "sessions_s").collect() if r.id != "zflush")
    table = windows.session_count(sensor, 900).select(
        "id", F.unix_millis(F.col("session_start").cast("timestamp")).alias("s"),
        F.unix_millis(F.col("session_end").cast("timestamp")).alias("e"), "cnt")
    assert got == rows(table, "id", "s", "e", "cnt")
    assert ("sensor1", 1547718199000, 1547719999000, 2) in got
