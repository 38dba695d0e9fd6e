"""The named queries: every operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. The ``events`` table plays the sensor stream (``id`` = event type,
``ts``, ``temp`` = value, ``seq`` = event id); durations are scaled to its
30-day span (tumble 1 h; slide 3 h / 1 h; session gap 30 min; delay 5 min;
lateness 1 h; rising timer 12 h keyed by user).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import aggregates, udfs
from tidemark.functions.columns import above, epoch_micros, steady
from tidemark.operators import alerts, outputs, rolling, routing, text, watermark, windows
from tidemark.sinks import writers
from tidemark.sources import readings as rd

# Test parameters (scaled reference values).
TUMBLE = "1 hour"
SLIDE_SIZE, SLIDE_STEP = "3 hours", "1 hour"
SLIDE_SIZE_S, SLIDE_STEP_S = 3 * 3600, 3600
SESSION_GAP_S = 30 * 60
DELAY_S, LATENESS_S = 300, 3600
SPLIT_T, SIDE_T, JUMP_T = 20.0, 30.0, 10.0
RISING_TIMER_S = 12 * 3600
COUNT_WINDOW = 10
OVER_PRECEDING = 2
FILTER_ID = "click"
MARKER_ID = "click"
PUNCT_MINUS_S = 1
HASH_FACTOR = udfs.HASH_FACTOR

#: Arrival order of the disordered view: keyed reduces, state and counts see rows as they come.
ARRIVAL = ("arrival", "seq")

Query = Callable[[SparkSession, str], DataFrame]


def _ev(spark: SparkSession, sf: str, id_col: str = "event_type") -> DataFrame:
    return rd.events_readings(spark, sf, id_col)


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return rd.with_arrival(_ev(spark, sf))


def _view(spark: SparkSession, sf: str, name: str = "readings") -> str:
    _ev(spark, sf).createOrReplaceTempView(name)
    return name


# ------------------------------------------------------------ ingest / projection

def q_parse_reading(spark, sf):
    ev = _ev(spark, sf)
    lines = ev.select(rd.reading_line(ev).alias("value"), "seq")
    return rd.parse_reading(lines).select("seq", "id", "timestamp", "temp")


def q_select_filter(spark, sf):
    return _ev(spark, sf).select("id", "temp").where(F.col("id") == FILTER_ID)


def q_select_filter_expr(spark, sf):
    return _ev(spark, sf).selectExpr("id", "temp").filter(f"id == '{FILTER_ID}'")


def q_sql_select_filter(spark, sf):
    v = _view(spark, sf)
    return spark.sql(f"SELECT id, temp FROM {v} WHERE id = '{FILTER_ID}'")


# ------------------------------------------------------------ text

def _docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("text")


def q_word_count(spark, sf):
    return text.word_count(_docs(spark, sf), "text", " ")


def q_word_count_nonempty(spark, sf):
    return text.word_count(_docs(spark, sf), "text", " ", drop_empty=True)


def q_rolling_word_count(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return text.rolling_word_count(docs, "text", ["doc_id"]).select("doc_id", "pos", "word", "count")


# ------------------------------------------------------------ rolling / grouped

def q_rolling_count(spark, sf):
    return rolling.rolling_count(_arrivals(spark, sf).select("id", "arrival", "seq"), order=ARRIVAL)


def q_rolling_reduce(spark, sf):
    return rolling.rolling_reduce(_arrivals(spark, sf), order=ARRIVAL)


def q_reduce_final(spark, sf):
    return rolling.reduce_final(_ev(spark, sf))


def q_min_by(spark, sf):
    return rolling.min_by_record(_arrivals(spark, sf), order=ARRIVAL)


def q_rolling_min_by(spark, sf):
    return rolling.rolling_min_by(_arrivals(spark, sf), order=ARRIVAL)


def q_group_count(spark, sf):
    return rolling.group_count(_ev(spark, sf))


def q_retract_avg(spark, sf):
    out = rolling.retract_avg(_arrivals(spark, sf), order=ARRIVAL)
    return out.withColumn("avg_temp", steady("avg_temp"))


def q_retract_min(spark, sf):
    return rolling.retract_changelog(rolling.rolling_reduce(_arrivals(spark, sf), order=ARRIVAL), "temp", order=ARRIVAL)


def q_top2_retract(spark, sf):
    return rolling.top2_retract(rd.with_arrival(_ev(spark, sf, "user_id")), order=ARRIVAL)


# ------------------------------------------------------------ routing

def q_split_tags(spark, sf):
    return routing.split_rows(_ev(spark, sf).select("seq", "id", "temp"), SPLIT_T)


def q_side_output_main(spark, sf):
    main, _ = routing.side_output(_ev(spark, sf), SIDE_T)
    return main.select("id", "timestamp", "temp", "seq")


def q_side_output_low(spark, sf):
    _, low = routing.side_output(_ev(spark, sf), SIDE_T)
    return low


def q_outputs_once(spark, sf):
    rows = _ev(spark, sf).select("seq", "id", "temp")
    high = above("temp", SPLIT_T)
    out = outputs.split_once(rows, {"high": high, "low": ~high, "side": F.col("temp") < SIDE_T})
    counts = [df.select(F.lit(name).alias("output"), "seq", "id", "temp") for name, df in out.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def q_mixed_elements(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    rows = ev.select(F.col("event_id").alias("seq"), F.posexplode(rd.mixed("user_id", "value", "event_type")).alias("pos", "v"))
    return rows.select("seq", "pos", F.coalesce(rd.typed("v", "bigint"), F.lit(-1)).alias("as_bigint"),
                       rd.typed("v", "double").alias("as_double"), rd.typed("v", "string").alias("as_string"))


def q_split_connect(spark, sf):
    return routing.split_connect(_ev(spark, sf).select("id", "temp", "seq"), SPLIT_T)


# ------------------------------------------------------------ windows

def q_tumble_table(spark, sf):
    return windows.tumble(_ev(spark, sf), TUMBLE).withColumn("avg_temp", steady("avg_temp"))


def q_tumble_sql(spark, sf):
    return windows.tumble_sql(spark, _view(spark, sf), f"'{TUMBLE}'").withColumn("avg_temp", steady("avg_temp"))


def q_sliding_count(spark, sf):
    return windows.sliding_count(_ev(spark, sf), SLIDE_SIZE, SLIDE_STEP)


def q_window_reduce(spark, sf):
    return windows.window_reduce(_ev(spark, sf), SLIDE_SIZE, SLIDE_STEP)


def q_session_count(spark, sf):
    return windows.session_count(_ev(spark, sf), SESSION_GAP_S)


def q_count_window(spark, sf):
    return windows.count_window(_arrivals(spark, sf), COUNT_WINDOW, order=ARRIVAL)


def q_over_rows(spark, sf):
    return windows.over_rows(_ev(spark, sf), OVER_PRECEDING).withColumn("avg_temp", steady("avg_temp"))


def q_over_rows_sql(spark, sf):
    return windows.over_rows_sql(spark, _view(spark, sf), OVER_PRECEDING).withColumn("avg_temp", steady("avg_temp"))


# ------------------------------------------------------------ watermarks

def q_watermark_periodic(spark, sf):
    return watermark.periodic_watermark(_arrivals(spark, sf).select("ts", "arrival", "seq"),
                                        DELAY_S).select("seq", "watermark")


def q_watermark_punctuated(spark, sf):
    return watermark.punctuated_watermark(_arrivals(spark, sf).select("id", "ts", "arrival", "seq"),
                                          MARKER_ID, PUNCT_MINUS_S).select("seq", "watermark")


def q_max_disorder(spark, sf):
    return watermark.max_disorder(_arrivals(spark, sf))


def q_late_rows(spark, sf):
    return watermark.late_rows(_arrivals(spark, sf).select("id", "ts", "arrival", "seq"),
                               SLIDE_SIZE_S, SLIDE_STEP_S, DELAY_S, LATENESS_S
                               ).select("id", "ts", "seq", "watermark")


def q_sliding_count_lateness(spark, sf):
    return watermark.sliding_count_lateness(_arrivals(spark, sf), SLIDE_SIZE_S, SLIDE_STEP_S,
                                            DELAY_S, LATENESS_S)


def q_window_firings(spark, sf):
    return watermark.window_firings(_arrivals(spark, sf), SLIDE_SIZE_S, SLIDE_STEP_S, DELAY_S, LATENESS_S)


# ------------------------------------------------------------ alerts

def q_temp_jump(spark, sf):
    return alerts.temp_jump(_arrivals(spark, sf), JUMP_T, order=ARRIVAL)


def q_temp_jump_zero_seed(spark, sf):
    return alerts.temp_jump(_arrivals(spark, sf), JUMP_T, seed_zero=True, order=ARRIVAL)


def q_temp_jump_map(spark, sf):
    return alerts.temp_jump_map(_arrivals(spark, sf), JUMP_T, order=ARRIVAL)


def q_rising_alarm(spark, sf):
    return alerts.rising_alarm(_ev(spark, sf, "user_id"), RISING_TIMER_S)


def q_rising_first_alarm(spark, sf):
    return alerts.rising_first_alarm(_ev(spark, sf, "user_id"), RISING_TIMER_S)


# ------------------------------------------------------------ functions

def _ev_user_ids(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.select(F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("id"),
                     F.col("event_id").alias("seq"))


def q_udf_hash_code(spark, sf):
    return _ev_user_ids(spark, sf).select("seq", "id", udfs.hash_code("id", HASH_FACTOR).alias("hash_code"))


def q_udaf_avg(spark, sf):
    return _ev(spark, sf).groupBy("id").agg(steady(udfs.avg_temp("temp")).alias("avg_temp"))


def q_udaf_avg_sql(spark, sf):
    udfs.register(spark)
    v = _view(spark, sf)
    return spark.sql(f"""SELECT id, avg_temp_value(sum(temp), count(temp)) AS avg_temp
                         FROM {v} GROUP BY id""").withColumn("avg_temp", steady("avg_temp"))


def _part(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_type")


def q_udtf_split(spark, sf):
    return udfs.split_udtf(_part(spark, sf), "p_type", " ")


def q_udtf_split_sql(spark, sf):
    udfs.register(spark)
    _part(spark, sf).createOrReplaceTempView("part_types")
    return spark.sql("""SELECT p_partkey, p_type, word, length
                        FROM part_types, LATERAL split_words(p_type, ' ')""")


def _edge_lines(spark, sf):
    """Types with empty text and leading, trailing, doubled and lone separators."""
    t = F.col("p_type")
    line = (F.when(F.col("p_partkey") % 5 == 0, F.lit("")).when(F.col("p_partkey") % 5 == 1, F.concat(F.lit(" "), t))
            .when(F.col("p_partkey") % 5 == 2, F.concat(t, F.lit("  ")))
            .when(F.col("p_partkey") % 5 == 3, F.replace(t, F.lit(" "), F.lit("  "))).otherwise(F.lit("   ")))
    return _part(spark, sf).select("p_partkey", line.alias("line"))


def q_split_edges(spark, sf):
    return udfs.split_udtf(_edge_lines(spark, sf), "line", " ")


def q_top2(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("temp"), F.col("o_orderkey").alias("seq"))
    return udfs.top2(o)


def q_user_aggregate(spark, sf):
    out = aggregates.aggregate(_ev(spark, sf), ["id"], aggregates.AvgTemp(), ["temp"])
    return out.withColumn("avg_temp", steady("avg_temp"))


def q_user_table_aggregate(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("temp"))
    return aggregates.aggregate(o, ["id"], aggregates.Top2Temp(), ["temp"])


def q_user_running_reduce(spark, sf):
    fold = aggregates.Reduce(aggregates.reduce_reading, "id string, timestamp bigint, temp double")
    out = aggregates.running(_arrivals(spark, sf), ["id"], ARRIVAL, fold, ["id", "timestamp", "temp"], keep=["arrival", "seq"])
    return out.select("id", "arrival", "seq", "timestamp", "temp")


# ------------------------------------------------------------ sinks

def q_keyed_latest(spark, sf):
    return writers.keyed_latest(_arrivals(spark, sf), F.col("temp").cast("string"), "id", order=ARRIVAL)


def q_document_json(spark, sf):
    return _ev(spark, sf).select("seq", writers.document_json().alias("doc"))


def q_csv_payload(spark, sf):
    return _ev(spark, sf).select("seq", writers.csv_payload("id", "temp").alias("value"))


def q_kafka_payload(spark, sf):
    return _ev(spark, sf).select("seq", writers.record_text().alias("value"))


def q_console_lines(spark, sf):
    return writers.labeled(_ev(spark, sf).select("id", "temp"), "result")


def q_positional_insert(spark, sf):
    return writers.insert_by_position(rolling.group_count(_ev(spark, sf)), ["id", "cnt"])


def q_epoch_millis_text(spark, sf):
    ev = _ev(spark, sf)
    ms = F.floor(epoch_micros("ts") / F.lit(1000)).cast("bigint")
    return ev.select("seq", rd.epoch_millis_text(ms).alias("text"))


QUERIES: dict[str, Query] = {
    "parse_reading": q_parse_reading,
    "select_filter": q_select_filter,
    "select_filter_expr": q_select_filter_expr,
    "sql_select_filter": q_sql_select_filter,
    "word_count": q_word_count,
    "word_count_nonempty": q_word_count_nonempty,
    "rolling_word_count": q_rolling_word_count,
    "rolling_count": q_rolling_count,
    "rolling_reduce": q_rolling_reduce,
    "reduce_final": q_reduce_final,
    "min_by": q_min_by,
    "rolling_min_by": q_rolling_min_by,
    "group_count": q_group_count,
    "split_tags": q_split_tags,
    "side_output_main": q_side_output_main,
    "side_output_low": q_side_output_low,
    "split_connect": q_split_connect,
    "outputs_once": q_outputs_once,
    "mixed_elements": q_mixed_elements,
    "tumble_table": q_tumble_table,
    "tumble_sql": q_tumble_sql,
    "sliding_count": q_sliding_count,
    "window_reduce": q_window_reduce,
    "session_count": q_session_count,
    "count_window": q_count_window,
    "over_rows": q_over_rows,
    "over_rows_sql": q_over_rows_sql,
    "watermark_periodic": q_watermark_periodic,
    "watermark_punctuated": q_watermark_punctuated,
    "max_disorder": q_max_disorder,
    "late_rows": q_late_rows,
    "sliding_count_lateness": q_sliding_count_lateness,
    "window_firings": q_window_firings,
    "temp_jump": q_temp_jump,
    "temp_jump_zero_seed": q_temp_jump_zero_seed,
    "temp_jump_map": q_temp_jump_map,
    "rising_alarm": q_rising_alarm,
    "rising_first_alarm": q_rising_first_alarm,
    "retract_avg": q_retract_avg,
    "retract_min": q_retract_min,
    "top2_retract": q_top2_retract,
    "udf_hash_code": q_udf_hash_code,
    "udaf_avg": q_udaf_avg,
    "udaf_avg_sql": q_udaf_avg_sql,
    "udtf_split": q_udtf_split,
    "udtf_split_sql": q_udtf_split_sql,
    "split_edges": q_split_edges,
    "top2": q_top2,
    "user_aggregate": q_user_aggregate,
    "user_table_aggregate": q_user_table_aggregate,
    "user_running_reduce": q_user_running_reduce,
    "keyed_latest": q_keyed_latest,
    "document_json": q_document_json,
    "csv_payload": q_csv_payload,
    "kafka_payload": q_kafka_payload,
    "console_lines": q_console_lines,
    "positional_insert": q_positional_insert,
    "epoch_millis_text": q_epoch_millis_text,
}
