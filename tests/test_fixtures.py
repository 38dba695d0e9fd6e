"""Goldens on the reference's own small fixtures (values from FIXTURES.md)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixture_rows import COLLECTION, HELLO_LINES, rows
from tidemark.functions import udfs
from tidemark.operators import alerts, rolling, routing, text, watermark, windows
from tidemark.sinks import writers
from tidemark.sources import readings as rd


def test_parse_and_filter(sensor):
    got = rows(sensor.where(F.col("id") == "sensor1").select("id", "temp"))
    assert got == [("sensor1", 0.89), ("sensor1", 5.6), ("sensor1", 78.6)]


def test_parse_strict_fails_and_quarantine(spark):
    bad = spark.createDataFrame([("x,notanumber,1.0",), ("a,1,2.0,extra",)], "value string")
    with pytest.raises(Exception):
        rd.parse_reading(bad).collect()
    q = rows(rd.parse_reading(bad, strict=False), "id", "timestamp", "temp", "parse_ok")
    assert q == [("a", 1, 2.0, True), ("x", None, 1.0, False)]


def test_time_units(spark):
    df = spark.createDataFrame([("a", 1547718199000, 1.0)], "id string, timestamp bigint, temp double")
    r = rd.as_readings(df, seq=None, unit="ms").first()
    assert r.ts == dt.datetime(2019, 1, 17, 9, 43, 19)


def test_word_count_batch_and_stream_forms(spark):
    lines = spark.createDataFrame([(l,) for l in HELLO_LINES], "value string")
    got = dict(rows(text.word_count(lines, "value")))
    assert got["hello"] == 3 and got["ha"] == 3 and len(got) == 10
    assert all(got[w] == 1 for w in ["flink", "java", "scala", "my", "name", "how", "are", "you"])


@pytest.mark.parametrize("s,expected", [
    ("a__b__", ["a", "", "b"]), ("", [""]), ("__", []), ("_a", ["", "a"]), ("a", ["a"]),
])
def test_jvm_split(spark, s, expected):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(text.jvm_split("s", "_").alias("a")).first().a == expected


def test_word_count_keeps_empty_words_batch_only(spark):
    lines = spark.createDataFrame([("a  b",), (" a",)], "value string")
    assert dict(rows(text.word_count(lines, "value")))[""] == 2
    assert "" not in dict(rows(text.word_count(lines, "value", drop_empty=True)))


def test_group_count_and_reduce(sensor):
    assert rows(rolling.group_count(sensor)) == [("sensor1", 3), ("sensor4", 5)]
    assert rows(rolling.reduce_final(sensor)) == [("sensor1", 1547729799, 0.89), ("sensor4", 1547740199, 35.6)]


def test_rolling_reduce(sensor):
    got = [(r.id, r.timestamp, r.temp) for r in rolling.rolling_reduce(sensor).orderBy("seq").collect()]
    assert got[:3] == [("sensor1", 1547718199, 0.89), ("sensor1", 1547719099, 0.89), ("sensor1", 1547729799, 0.89)]
    assert got[3:] == [("sensor4", 1547740199, 35.6)] * 5


def test_min_by(sensor):
    got = rows(rolling.min_by_record(sensor), "id", "timestamp", "temp")
    assert got == [("sensor1", 1547718199, 0.89), ("sensor4", 1547740199, 35.6)]
    roll = rolling.rolling_min_by(sensor).orderBy("seq").collect()
    assert [r.min_temp for r in roll] == [0.89, 0.89, 0.89, 35.6, 35.6, 35.6, 35.6, 35.6]


def test_split_side_output_connect(sensor):
    tagged = routing.tag_split(sensor, 20)
    assert sorted(r.seq for r in routing.select_tag(tagged, "high").collect()) == [2, 3, 4, 5, 6, 7]
    assert sorted(r.seq for r in routing.select_tag(tagged, "low").collect()) == [0, 1]
    main, low = routing.side_output(sensor, 30)
    assert sorted(r.seq for r in main.collect()) == [2, 3, 4, 5, 6, 7]
    assert rows(low, "id", "temp", "timestamp") == [("sensor1", 0.89, 1547718199), ("sensor1", 5.6, 1547719099)]
    con = routing.split_connect(sensor, 20)
    assert con.where("status = 'warn'").count() == 6
    assert rows(con.where("status = 'normal'"), "id", "temp") == [("sensor1", None), ("sensor1", None)]


def test_nan_goes_low(spark):
    df = rd.from_rows(spark, [("a", 1, float("nan")), ("a", 2, 25.0)])
    tagged = routing.tag_split(df, 20)
    assert [r.seq for r in routing.select_tag(tagged, "high").collect()] == [1]


def test_sliding_count(sensor):
    got = rows(windows.sliding_count(sensor, "15 seconds", "5 seconds"))
    s1 = [("sensor1", s * 1000, 1) for s in (1547718185, 1547718190, 1547718195, 1547719085, 1547719090,
                                              1547719095, 1547729785, 1547729790, 1547729795)]
    s4 = [("sensor4", s * 1000, 5) for s in (1547740185, 1547740190, 1547740195)]
    assert got == sorted(s1 + s4)


def test_tumble(sensor):
    got = rows(windows.tumble(sensor, "10 seconds"), "id", "cnt", "avg_temp", "window_end")
    d = lambda h, m, s: dt.datetime(2019, 1, 17, h, m, s)
    assert got == [("sensor1", 1, 0.89, d(9, 43, 20)), ("sensor1", 1, 5.6, d(9, 58, 20)),
                   ("sensor1", 1, 78.6, d(12, 56, 40)), ("sensor4", 5, 68.72, d(15, 50, 0))]


def test_tumble_sql_equals_api(spark, sensor):
    sensor.createOrReplaceTempView("sensor_view")
    assert rows(windows.tumble_sql(spark, "sensor_view", "'10 seconds'")) == rows(windows.tumble(sensor, "10 seconds"))


def test_session(sensor):
    got = windows.session_count(sensor, 60)
    assert got.count() == 4 and got.where("id = 'sensor1'").count() == 3


def test_count_window_equals_rolling_reduce(sensor):
    cw = windows.count_window(sensor, 10).orderBy("seq").collect()
    rr = rolling.rolling_reduce(sensor).orderBy("seq").collect()
    assert [(r.max_timestamp, r.min_temp) for r in cw] == [(r.timestamp, r.temp) for r in rr]


def test_over_rows(spark, sensor):
    got = [(r.id, r.cnt, round(r.avg_temp, 6)) for r in windows.over_rows(sensor, 2).orderBy("seq").collect()]
    assert got == [("sensor1", 1, 0.89), ("sensor1", 2, 3.245), ("sensor1", 3, 28.363333),
                   ("sensor4", 1, 35.6), ("sensor4", 2, 61.8), ("sensor4", 3, 74.2),
                   ("sensor4", 3, 84.333333), ("sensor4", 3, 73.333333)]
    sensor.createOrReplaceTempView("sensor_over")
    sql = [(r.id, r.cnt, round(r.avg_temp, 6)) for r in windows.over_rows_sql(spark, "sensor_over").orderBy("seq").collect()]
    assert sql == got


def test_temp_jumps(sensor):
    j = rows(alerts.temp_jump(sensor, 10), "id", "last_temp", "temp")
    expected = [("sensor1", 5.6, 78.6), ("sensor4", 35.6, 88.0), ("sensor4", 66.0, 55.0),
                ("sensor4", 88.0, 99.0), ("sensor4", 99.0, 66.0)]
    assert j == expected
    z = rows(alerts.temp_jump(sensor, 10, seed_zero=True), "id", "last_temp", "temp")
    assert z == sorted(expected + [("sensor4", 0.0, 35.6)])
    m = alerts.temp_jump_map(sensor, 10).orderBy("seq").collect()
    assert len(m) == 8 and m[0].jump_id is None and m[1].jump_id is None
    assert sum(r.jump_id is not None for r in m) == 6


def test_rising_alarm(sensor):
    got = rows(alerts.rising_alarm(sensor, 10), "id", "alarm_ts")
    assert got == [("sensor1", dt.datetime(1970, 1, 1) + dt.timedelta(seconds=t)) for t in (1547718209, 1547719109, 1547729809)]
    assert all(r.message == "温度连续上升10秒" for r in alerts.rising_alarm(sensor, 10).collect())


def test_rising_alarm_edges(spark):
    # negative first temp never arms; equal temps neither arm nor cancel
    df = rd.as_readings(rd.from_rows(spark, [("a", 0, -1.0), ("a", 1, -1.0), ("b", 0, 5.0), ("b", 3, 5.0),
                                             ("b", 20, 6.0), ("b", 25, 7.0), ("b", 31, 8.0)]))
    got = rows(alerts.rising_alarm(df, 10), "id", "alarm_ts")
    e = dt.datetime(1970, 1, 1)
    # b: arm at 0 -> fires 10 (taken at row 20); row 20 rises -> arm 30; 31 >= 30 fires, 31 rises -> arm 41
    assert got == [("b", e + dt.timedelta(seconds=10)), ("b", e + dt.timedelta(seconds=30)),
                   ("b", e + dt.timedelta(seconds=41))]


def test_rising_alarm_long_chain(spark):
    df = rd.as_readings(rd.from_rows(spark, [("k", t, float(t)) for t in range(0, 400, 3)]))  # one strictly rising run
    at, exp = None, []
    for t in range(3, 400, 3):  # t = 0 does not rise above the initial 0.0
        if at is None or t >= at:
            at = t + 10
            exp.append(at)
    e = dt.datetime(1970, 1, 1)
    assert rows(alerts.rising_alarm(df, 10), "alarm_ts") == [(e + dt.timedelta(seconds=t),) for t in exp]


def test_rising_alarm_null_key_and_shared_seq(spark):
    """Two keys with the same arrival numbers, one of them NULL: each has its own chain."""
    data = [(k, t, float(t + 1), i) for k in (None, "a") for i, t in enumerate(range(0, 240, 4))]
    df = rd.as_readings(spark.createDataFrame(data, "id string, timestamp long, temp double, seq long"))
    got = [r.id for r in alerts.rising_alarm(df, 15).collect()]
    assert got.count(None) == got.count("a") == 15
    assert sorted(str(r.id) for r in alerts.rising_first_alarm(df, 15).collect()) == ["None", "a"]


def test_arrival_order_decides(spark):
    """Rows out of time order: keyed state sees them as they came."""
    df = rd.as_readings(rd.from_rows(spark, [("a", 100, 0.0), ("a", 50, 50.0), ("a", 200, 5.0)]))
    assert rows(alerts.temp_jump(df, 10.0), "last_temp", "temp") == [(0.0, 50.0), (50.0, 5.0)]
    assert rows(writers.keyed_latest(df, "id", "temp")) == [("a", 5.0)]
    assert [r.avg_temp for r in rolling.retract_avg(df).where("is_add").orderBy("seq").collect()] == [0.0, 25.0, 55.0 / 3]
    tie = rd.as_readings(rd.from_rows(spark, [("a", 9, 1.0), ("a", 3, 1.0)]))
    assert rolling.min_by_record(tie).first().timestamp == 9


def test_averages_and_nan(spark):
    nan = float("nan")
    df = rd.as_readings(rd.from_rows(spark, [("t", 1, 1e-11), ("t", 2, 3e-11), ("b", 1, 1e30), ("n", 1, 1.0), ("n", 2, nan)]))
    got = dict(rows(df.groupBy("id").agg(udfs.avg_temp("temp"))))
    assert got["t"] == pytest.approx(2e-11) and got["b"] == 1e30 and got["n"] != got["n"]
    red = dict((i, t) for i, _, t in rows(rolling.reduce_final(df)))
    assert red["n"] != red["n"] and red["t"] == 1e-11
    roll = [r.temp for r in rolling.rolling_reduce(df).where("id = 'n'").orderBy("seq").collect()]
    assert roll[0] == 1.0 and roll[1] != roll[1]
    win = windows.window_reduce(df, "1 hour").where("id = 'n'").first().temp
    assert win != win
    assert rolling.min_by_record(df).where("id = 'n'").first().temp == 1.0  # NaN orders last, final and rolling
    assert [r.min_temp for r in rolling.rolling_min_by(df).where("id = 'n'").orderBy("seq").collect()] == [1.0, 1.0]


def test_strict_parse_survives_pruning(spark):
    bad = spark.createDataFrame([("x,notanumber,1.0",), ("a,1,2.0",)], "value string")
    for use in (lambda d: d.select("id").collect(), lambda d: d.select("temp").collect(), lambda d: d.count(),
                lambda d: rolling.group_count(d).collect()):
        with pytest.raises(Exception, match="malformed reading"):
            use(rd.parse_reading(bad))
    piped = spark.createDataFrame([("a|1|2.5",)], "value string")
    assert rows(rd.parse_reading(piped, sep="|")) == [("a", 1, 2.5)]


def test_lines_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "part-0").write_text("first\n")
    (tmp_path / "part-1").write_text("".join(f"line {i}\n" for i in range(500)))
    got = [r.value for r in rd.read_lines(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == ["first"] + [f"line {i}" for i in range(500)]


def test_user_bodies(sensor):
    got = windows.window_aggregate(sensor, [F.max("temp").alias("hi"), F.count(F.lit(1)).alias("n")], "1 hour")
    assert got.columns == ["id", "window_start", "hi", "n"] and got.count() > 0
    assert dict(rows(rolling.reduce_final(sensor, body=[F.sum("temp").alias("s")])))["sensor1"] == pytest.approx(85.09)

    def spread(key, start, pdf):
        return pdf.iloc[:1][["id"]].assign(spread=pdf["temp"].max() - pdf["temp"].min())

    whole = windows.window_process(sensor, spread, "id string, spread double", "1 day")
    assert {i: round(v, 2) for i, v in rows(whole)} == {"sensor1": 77.71, "sensor4": 63.4}


def test_csv_payload_is_strict(spark):
    df = spark.createDataFrame([("a,1.5",), ("b,notanumber",)], "v string")
    lenient = df.select(writers.parse_csv_payload("v", "id STRING, temp DOUBLE", strict=False).alias("p"))
    assert [r.p.temp for r in lenient.collect()] == [1.5, None]
    with pytest.raises(Exception):
        df.select(writers.parse_csv_payload("v", "id STRING, temp DOUBLE").alias("p")).collect()


def test_window_firings(spark):
    """Counts of one window by hand: on time with two rows, then once for each late row within the lateness."""
    df = rd.as_readings(rd.from_rows(spark, [("a", 1, 1.0), ("a", 4, 1.0), ("a", 40, 1.0), ("a", 2, 1.0), ("a", 3, 1.0), ("a", 500, 1.0), ("a", 5, 1.0)]))
    df = df.withColumn("arrival", F.col("seq"))
    got = sorted((r.window_start_ms, r.late, r.cnt) for r in watermark.window_firings(df, 10, 10, 5, 60).collect())
    assert got == [(0, False, 2), (0, True, 3), (0, True, 4), (40000, False, 1), (500000, False, 1)]


def test_hash_code(spark, sensor):
    got = dict(rows(sensor.select("id", udfs.hash_code("id").alias("h")).distinct()))
    assert got == {"sensor1": 309289421, "sensor4": 309289454}
    udfs.register(spark)
    sensor.createOrReplaceTempView("sensor_h")
    sql = dict(rows(spark.sql("SELECT DISTINCT id, hash_code(id, 11) AS h FROM sensor_h")))
    assert sql == got
    # wrap-around, empty string and a character outside the BMP agree with the JVM
    cases = {"a-much-longer-identifier-0001": None, "": None, "x\U0001D11Ey": None}
    for s in cases:
        h = 0
        for unit in [int.from_bytes(s.encode("utf-16-be")[i:i + 2], "big") for i in range(0, len(s.encode("utf-16-be")), 2)]:
            h = (h * 31 + unit) & 0xFFFFFFFF
        v = (h * 11 - 10000) & 0xFFFFFFFF
        cases[s] = v - (1 << 32) if v >= (1 << 31) else v
    df = spark.createDataFrame([(s,) for s in cases], "id string")
    assert dict(rows(df.select("id", udfs.hash_code("id").alias("h")))) == cases


def test_avg_udaf_forms(spark, sensor):
    api = {k: round(v, 6) for k, v in rows(sensor.groupBy("id").agg(udfs.avg_temp("temp").alias("a")))}
    assert api == {"sensor1": 28.363333, "sensor4": 68.72}
    udfs.register(spark)
    sensor.createOrReplaceTempView("sensor_avg")
    py = {k: round(v, 6) for k, v in rows(spark.sql("SELECT id, avg_temp_udaf(temp) FROM sensor_avg GROUP BY id"))}
    assert py == api


def test_split_udtf_forms(spark, sensor):
    api = rows(udfs.split_udtf(sensor, "id", "_"), "id", "word", "length")
    assert len(api) == 8 and all(w == i and n == 7 for i, w, n in api)
    udfs.register(spark)
    df = spark.createDataFrame([("a__b__",), ("",), ("__",), ("_a",)], "s string")
    df.createOrReplaceTempView("split_in")
    sql = rows(spark.sql("SELECT s, word, length FROM split_in, LATERAL split_words(s, '_')"))
    py = rows(spark.sql("SELECT s, word, length FROM split_in, LATERAL split_words_py(s, '_')"))
    native = rows(udfs.split_udtf(df, "s", "_"), "s", "word", "length")
    assert sql == py == native == sorted([("a__b__", "a", 1), ("a__b__", "", 0), ("a__b__", "b", 1),
                                          ("", "", 0), ("_a", "", 0), ("_a", "a", 1)])


def test_top2(spark, sensor):
    got = rows(udfs.top2(sensor), "id", "temp", "rank")
    assert got == [("sensor1", 5.6, 2), ("sensor1", 78.6, 1), ("sensor4", 88.0, 2), ("sensor4", 99.0, 1)]
    coll = rows(udfs.top2(rd.from_rows(spark, COLLECTION)), "id", "temp", "rank")
    assert coll == sorted([(k, t, 1) for k, _, t in COLLECTION] + [(k, udfs.DOUBLE_MIN, 2) for k, _, _ in COLLECTION])
    edge = rd.from_rows(spark, [("one", 1, 55.5), ("eq", 1, 5.0), ("eq", 2, 5.0),
                                ("nan", 1, float("nan")), ("nan", 2, float("-inf"))])
    e = rows(udfs.top2(edge), "id", "temp", "rank")
    assert e == sorted([("one", 55.5, 1), ("one", udfs.DOUBLE_MIN, 2), ("eq", 5.0, 1), ("eq", 5.0, 2),
                        ("nan", udfs.DOUBLE_MIN, 1), ("nan", udfs.DOUBLE_MIN, 2)])


def test_retract_avg(sensor):
    got = rolling.retract_avg(sensor).orderBy("seq", "change").collect()
    seq = [(r.id, r.is_add, round(r.avg_temp, 6)) for r in got]
    assert seq == [("sensor1", True, 0.89), ("sensor1", False, 0.89), ("sensor1", True, 3.245),
                   ("sensor1", False, 3.245), ("sensor1", True, 28.363333),
                   ("sensor4", True, 35.6), ("sensor4", False, 35.6), ("sensor4", True, 61.8),
                   ("sensor4", False, 61.8), ("sensor4", True, 74.2), ("sensor4", False, 74.2),
                   ("sensor4", True, 72.15), ("sensor4", False, 72.15), ("sensor4", True, 68.72)]


def test_retract_skips_unchanged(spark):
    df = rd.as_readings(rd.from_rows(spark, [("a", 1, 2.0), ("a", 2, 2.0)]))
    assert rolling.retract_avg(df).count() == 1


def test_payloads(sensor):
    first = sensor.where("seq = 0").select(writers.record_text().alias("v")).first().v
    assert first == "SensorReading(sensor1,1547718199,0.89)"
    doc = sensor.where("seq = 3").select(writers.document_json().alias("v")).first().v
    assert doc == '{"id":"sensor4","temp":"35.6","time":"1547740199"}'
    csv = sensor.where("seq = 3").select(writers.csv_payload("id", "temp").alias("v")).first().v
    assert csv == "sensor4,35.6"
    parsed = sensor.where("seq = 3").select(writers.parse_csv_payload(writers.csv_payload("id", "temp"),
                                                                      "id STRING, temp DOUBLE").alias("p")).first().p
    assert (parsed.id, parsed.temp) == ("sensor4", 35.6)


def test_keyed_latest(sensor):
    got = dict(rows(writers.keyed_latest(sensor, F.col("temp").cast("string"), "id")))
    assert got == {"0.89": "sensor1", "5.6": "sensor1", "78.6": "sensor1", "35.6": "sensor4",
                   "88.0": "sensor4", "99.0": "sensor4", "66.0": "sensor4", "55.0": "sensor4"}


def test_epoch_millis_text(spark):
    df = spark.createDataFrame([(1599113010000,)], "ms bigint")
    assert df.select(rd.epoch_millis_text(F.col("ms")).alias("t")).first().t == "Thu Sep 03 06:03:30 UTC 2020"


def test_watermarks(sensor):
    arr = sensor.withColumn("arrival", F.col("ts"))
    p = [r.watermark for r in watermark.periodic_watermark(arr, 5).orderBy("seq").collect()]
    assert [int((w - dt.datetime(1970, 1, 1)).total_seconds()) for w in p] == \
        [1547718194, 1547719094, 1547729794] + [1547740194] * 5
    q = [r.watermark for r in watermark.punctuated_watermark(arr, "sensor1", 1).orderBy("seq").collect()]
    assert [int((w - dt.datetime(1970, 1, 1)).total_seconds()) for w in q] == \
        [1547718198, 1547719098] + [1547729798] * 6
    assert watermark.max_disorder(arr).first().max_disorder_us == 0


def test_late_case(spark):
    df = rd.as_readings(rd.from_rows(spark, [("k", 1000, 1.0), ("k", 1100, 1.0), ("k", 1020, 1.0),
                                             ("k", 1025, 1.0), ("k", 1030, 1.0)]))
    df = df.withColumn("arrival", F.timestamp_add("SECOND", F.col("seq"), F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz")))
    late = watermark.late_rows(df, 15, 5, 5, 60)
    assert [r.seq for r in late.collect()] == [2]
    counts = dict(rows(watermark.sliding_count_lateness(df, 15, 5, 5, 60), "window_start_ms", "cnt"))
    assert counts == {990000: 1, 995000: 1, 1000000: 1, 1090000: 1, 1095000: 1, 1100000: 1,
                      1030000: 1, 1025000: 2}


def test_positional_insert(sensor):
    out = writers.insert_by_position(rolling.group_count(sensor), ["id", "cnt"])
    assert out.columns == ["id", "cnt"]
