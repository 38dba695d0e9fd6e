"""Reference SQL for every named query, in DuckDB's dialect.

Each statement reads the same parquet tables (views ``events``,
``documents``, ``part``, ``orders``) and must give the same multiset of
rows, with the same column names, as the Spark query of the same key.
Running and ordered forms use window functions over the whole key;
the rising alarm is a recursive CTE that steps row by row per key.
"""

from __future__ import annotations

from tidemark.plans import catalog as c
from tidemark.operators.alerts import ALARM_PREFIX, ALARM_SUFFIX
from tidemark.functions.udfs import DOUBLE_MIN, HASH_OFFSET

READINGS = """readings AS (
    SELECT event_type AS id, ts, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS timestamp,
           value AS temp, event_id AS seq
    FROM events)"""

ARRIVALS = f"""arrivals AS (
    SELECT *, ts + to_seconds((seq * 7919) % 21600) AS arrival, epoch_us(ts) AS t
    FROM readings)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


R = _with(READINGS)
RA = _with(READINGS, ARRIVALS)

# JVM String.hashCode (ASCII ids), times factor, minus offset, 32-bit wrap.
_FOLD = ("list_reduce(list_transform(string_split(id, ''), lambda x: CAST(unicode(x) AS BIGINT)), "
         "lambda h, x: (h * 31 + x) % 4294967296, CAST(0 AS BIGINT))")
_U32 = f"((({_FOLD}) * {c.HASH_FACTOR} - {HASH_OFFSET}) % 4294967296 + 4294967296) % 4294967296"
_HASH = f"CAST(({_U32} + 2147483648) % 4294967296 - 2147483648 AS INTEGER)"

def _steady(x: str) -> str:
    """A double at six decimals, halves upwards, as ``columns.steady``."""
    return f"floor(({x}) * 1e6::DOUBLE + 0.5001::DOUBLE) / 1e6::DOUBLE"


_AVG = _steady("avg(temp)")
_SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BY_ARRIVAL = f"(PARTITION BY id ORDER BY arrival, seq {_SO_FAR})"

_WM_BEFORE = f"""wm AS (
    SELECT *, max(t) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - {c.DELAY_S * 1000000} AS wm
    FROM arrivals)"""

_RISING = f"""WITH RECURSIVE r AS (
    SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) AS t, value AS temp,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
    FROM events),
s AS (
    SELECT id, rn, temp AS last_temp,
           CASE WHEN temp > 0.0 THEN t + {c.RISING_TIMER_S * 1000000} END AS timer,
           CAST(NULL AS BIGINT) AS fired
    FROM r WHERE rn = 1
    UNION ALL
    SELECT r.id, r.rn, r.temp,
           CASE WHEN s.timer IS NOT NULL AND r.t >= s.timer
                     THEN CASE WHEN r.temp > s.last_temp THEN r.t + {c.RISING_TIMER_S * 1000000} END
                WHEN r.temp > s.last_temp AND s.timer IS NULL THEN r.t + {c.RISING_TIMER_S * 1000000}
                WHEN r.temp < s.last_temp THEN NULL
                ELSE s.timer END,
           CASE WHEN s.timer IS NOT NULL AND r.t >= s.timer THEN s.timer END
    FROM s JOIN r ON r.id = s.id AND r.rn = s.rn + 1),
last_row AS (SELECT id, max(rn) AS rn FROM r GROUP BY id)
SELECT id, make_timestamp(fired) AS alarm_ts, '{ALARM_PREFIX}{c.RISING_TIMER_S}{ALARM_SUFFIX}' AS message
FROM s WHERE fired IS NOT NULL
UNION ALL
SELECT s.id, make_timestamp(s.timer) AS alarm_ts, '{ALARM_PREFIX}{c.RISING_TIMER_S}{ALARM_SUFFIX}' AS message
FROM s JOIN last_row USING (id, rn) WHERE s.timer IS NOT NULL"""

_RUNS = f"""WITH u AS (
    SELECT CAST(user_id AS VARCHAR) AS id, ts, event_id AS seq, epoch_us(ts) AS t, value AS temp,
           coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS last_temp
    FROM events),
f AS (
    SELECT *, temp > last_temp AS rise, temp < last_temp AS fall FROM u),
g AS (
    SELECT *, coalesce(sum(CAST(fall AS BIGINT)) OVER (PARTITION BY id ORDER BY ts, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM f),
runs AS (
    SELECT id, run, min(CASE WHEN rise THEN t END) AS a, max(CASE WHEN fall THEN t END) AS tf
    FROM g GROUP BY id, run)
SELECT id, make_timestamp(a + {c.RISING_TIMER_S * 1000000}) AS alarm_ts FROM runs
WHERE a IS NOT NULL AND (tf IS NULL OR tf >= a + {c.RISING_TIMER_S * 1000000})"""

_SPLIT_PARTS = """WITH p AS (SELECT p_partkey, p_type, rtrim(p_type, ' ') AS s FROM part),
w AS (
    SELECT p_partkey, p_type, unnest(CASE WHEN p_type = '' THEN [''] WHEN s = '' THEN []
                                          ELSE string_split(s, ' ') END) AS word
    FROM p)
SELECT p_partkey, p_type, word, CAST(length(word) AS INTEGER) AS length FROM w"""

_WORDS = """WITH d AS (SELECT text, regexp_replace(text, ' +$', '') AS s FROM documents),
w AS (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN s = '' THEN [] ELSE string_split(s, ' ') END) AS word
      FROM d)
"""

_OVER = R + f"""SELECT id, ts, seq, count(temp) OVER ow AS cnt, {_steady("avg(temp) OVER ow")} AS avg_temp
        FROM readings WINDOW ow AS (PARTITION BY id ORDER BY ts, seq
                                    ROWS BETWEEN {c.OVER_PRECEDING} PRECEDING AND CURRENT ROW)"""

# Row by row: the two highest values a key has seen before and after each arrival.
_TOP2_SEEN = f"""WITH r AS (
    SELECT CAST(user_id AS VARCHAR) AS id, ts + to_seconds((event_id * 7919) % 21600) AS arrival, event_id AS seq, value AS temp
    FROM events),
s AS (SELECT *, list_reverse_sort(list(temp) OVER {_BY_ARRIVAL}) AS seen,
             list_reverse_sort(list(temp) OVER (PARTITION BY id ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS old FROM r),
v AS (SELECT *, unnest([1, 2]) AS rank FROM s
      WHERE old IS NULL OR len(old) = 0 OR seen[1:2] <> old[1:2])
SELECT id, arrival, seq, false AS is_add, 0 AS change, coalesce(old[rank], {DOUBLE_MIN!r}) AS temp, rank FROM v WHERE len(old) > 0
UNION ALL
SELECT id, arrival, seq, true AS is_add, 1 AS change, coalesce(seen[rank], {DOUBLE_MIN!r}) AS temp, rank FROM v"""

_EDGES = """WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' || p_type WHEN 2 THEN p_type || '  '
                                      WHEN 3 THEN replace(p_type, ' ', '  ') ELSE '   ' END AS line FROM part),
w AS (SELECT p_partkey, line, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                                          ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM p)
SELECT p_partkey, line, word, CAST(length(word) AS INTEGER) AS length FROM w"""

ORACLE: dict[str, str] = {
    "parse_reading": R + "SELECT seq, id, timestamp, temp FROM readings",
    "select_filter": R + f"SELECT id, temp FROM readings WHERE id = '{c.FILTER_ID}'",
    "select_filter_expr": R + f"SELECT id, temp FROM readings WHERE id = '{c.FILTER_ID}'",
    "sql_select_filter": R + f"SELECT id, temp FROM readings WHERE id = '{c.FILTER_ID}'",
    "word_count": _WORDS + "SELECT word, count(*) AS count FROM w GROUP BY word",
    "word_count_nonempty": _WORDS + "SELECT word, count(*) AS count FROM w WHERE word <> '' GROUP BY word",
    "rolling_count": RA + f"SELECT id, arrival, seq, count(*) OVER {_BY_ARRIVAL} AS count FROM arrivals",
    "rolling_reduce": RA + f"""SELECT id, arrival, seq,
            max(timestamp) OVER w AS timestamp, min(temp) OVER w AS temp
        FROM arrivals WINDOW w AS {_BY_ARRIVAL}""",
    "reduce_final": R + "SELECT id, max(timestamp) AS timestamp, min(temp) AS temp FROM readings GROUP BY id",
    "min_by": RA + """SELECT id, timestamp, temp, seq FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY temp, arrival, seq) AS rn FROM arrivals)
        WHERE rn = 1""",
    "rolling_min_by": RA + f"""SELECT id, arrival, seq, m.timestamp AS min_timestamp, m.temp AS min_temp FROM (
            SELECT id, arrival, seq, arg_min({{'timestamp': timestamp, 'temp': temp}}, (temp, arrival, seq)) OVER {_BY_ARRIVAL} AS m
            FROM arrivals)""",
    "rolling_word_count": """WITH d AS (SELECT doc_id, text, rtrim(text, ' ') AS s FROM documents),
        l AS (SELECT doc_id, CASE WHEN text = '' THEN [''] WHEN s = '' THEN [] ELSE string_split(s, ' ') END AS ws
              FROM d),
        t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS pos FROM l)
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, word,
               count(*) OVER (PARTITION BY word ORDER BY doc_id, pos
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS count
        FROM t WHERE word <> ''""",
    "group_count": R + "SELECT id, count(id) AS count FROM readings GROUP BY id",
    "split_tags": R + f"""SELECT seq, id, temp,
            CASE WHEN temp > {c.SPLIT_T} AND NOT isnan(temp) THEN 'high' ELSE 'low' END AS tag
        FROM readings""",
    "side_output_main": R + f"""SELECT id, timestamp, temp, seq FROM readings
        WHERE temp > {c.SIDE_T} AND NOT isnan(temp)""",
    "side_output_low": R + f"""SELECT id, temp, timestamp, seq FROM readings
        WHERE NOT (temp > {c.SIDE_T} AND NOT isnan(temp))""",
    "split_connect": R + f"""SELECT id, temp, 'warn' AS status, seq FROM readings
            WHERE temp > {c.SPLIT_T} AND NOT isnan(temp)
        UNION ALL
        SELECT id, NULL AS temp, 'normal' AS status, seq FROM readings
            WHERE NOT (temp > {c.SPLIT_T} AND NOT isnan(temp))""",
    "tumble_table": R + f"""SELECT id, count(id) AS cnt, {_AVG} AS avg_temp,
            time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
        FROM readings GROUP BY id, time_bucket(INTERVAL 1 HOUR, ts)""",
    "tumble_sql": R + f"""SELECT id, count(id) AS cnt, {_AVG} AS avg_temp,
            time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
        FROM readings GROUP BY id, time_bucket(INTERVAL 1 HOUR, ts)""",
    "sliding_count": R + """, w AS (
            SELECT id, time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS ws
            FROM readings, (SELECT unnest(range(0, 3)) AS k) ks)
        SELECT id, CAST(epoch_ms(ws) AS BIGINT) AS window_start_ms, CAST(count(*) AS INTEGER) AS cnt
        FROM w GROUP BY id, ws""",
    "window_reduce": R + """, w AS (
            SELECT id, timestamp, temp, time_bucket(INTERVAL 1 HOUR, ts) - to_hours(k) AS ws
            FROM readings, (SELECT unnest(range(0, 3)) AS k) ks)
        SELECT id, ws AS window_start, max(timestamp) AS timestamp, min(temp) AS temp
        FROM w GROUP BY id, ws""",
    "session_count": R + f""", s AS (
            SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY id ORDER BY ts, seq) IS NULL
                             OR ts - lag(ts) OVER (PARTITION BY id ORDER BY ts, seq) > INTERVAL 30 MINUTE
                           THEN 1 ELSE 0 END AS new_session
            FROM readings),
        n AS (SELECT *, sum(new_session) OVER (PARTITION BY id ORDER BY ts, seq
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM s)
        SELECT id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS cnt
        FROM n GROUP BY id, sid""",
    "count_window": RA + f"""SELECT id, arrival, seq, count(*) OVER w AS cnt, max(timestamp) OVER w AS max_timestamp,
            min(temp) OVER w AS min_temp
        FROM arrivals WINDOW w AS (PARTITION BY id ORDER BY arrival, seq
                                   ROWS BETWEEN {c.COUNT_WINDOW - 1} PRECEDING AND CURRENT ROW)""",
    "over_rows": _OVER,
    "over_rows_sql": _OVER,
    "watermark_periodic": RA + f"""SELECT seq, make_timestamp(max(t) OVER (ORDER BY arrival, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {c.DELAY_S * 1000000}) AS watermark
        FROM arrivals""",
    "watermark_punctuated": RA + f"""SELECT seq, make_timestamp(max(CASE WHEN id = '{c.MARKER_ID}'
            THEN t - {c.PUNCT_MINUS_S * 1000000} END) OVER (ORDER BY arrival, seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS watermark
        FROM arrivals""",
    "max_disorder": RA + """SELECT max(m - t) AS max_disorder_us FROM (
            SELECT t, max(t) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
            FROM arrivals)""",
    "late_rows": _with(READINGS, ARRIVALS, _WM_BEFORE) + f"""SELECT id, ts, seq, make_timestamp(wm) AS watermark
        FROM wm
        WHERE wm IS NOT NULL
          AND t - (t % {c.SLIDE_STEP_S * 1000000}) + {c.SLIDE_SIZE_S * 1000000} - 1000
              + {c.LATENESS_S * 1000000} <= wm""",
    "sliding_count_lateness": _with(READINGS, ARRIVALS, _WM_BEFORE) + f""", p AS (
            SELECT id, wm, t - (t % {c.SLIDE_STEP_S * 1000000}) - k * {c.SLIDE_STEP_S * 1000000} AS ws
            FROM wm, (SELECT unnest(range(0, {c.SLIDE_SIZE_S // c.SLIDE_STEP_S})) AS k) ks)
        SELECT id, CAST(ws / 1000 AS BIGINT) AS window_start_ms, CAST(count(*) AS INTEGER) AS cnt
        FROM p
        WHERE wm IS NULL OR ws + {c.SLIDE_SIZE_S * 1000000} - 1000 + {c.LATENESS_S * 1000000} > wm
        GROUP BY id, ws""",
    "window_firings": _with(READINGS, ARRIVALS, _WM_BEFORE) + f""", p AS (
            SELECT id, wm, arrival, seq, t - (t % {c.SLIDE_STEP_S * 1000000}) - k * {c.SLIDE_STEP_S * 1000000} AS ws
            FROM wm, (SELECT unnest(range(0, {c.SLIDE_SIZE_S // c.SLIDE_STEP_S})) AS k) ks),
        q AS (SELECT *, wm IS NOT NULL AND ws + {c.SLIDE_SIZE_S * 1000000} - 1000 <= wm AS late FROM p
              WHERE wm IS NULL OR ws + {c.SLIDE_SIZE_S * 1000000} - 1000 + {c.LATENESS_S * 1000000} > wm),
        n AS (SELECT *, count(*) OVER (PARTITION BY id, ws ORDER BY arrival, seq {_SO_FAR}) AS cnt FROM q)
        SELECT id, CAST(ws / 1000 AS BIGINT) AS window_start_ms, CAST(cnt AS INTEGER) AS cnt, late FROM n WHERE late
        UNION ALL
        SELECT id, CAST(ws / 1000 AS BIGINT), CAST(count(*) AS INTEGER), false FROM n WHERE NOT late GROUP BY id, ws""",
    "temp_jump": RA + f"""SELECT id, arrival, seq, last_temp, temp FROM (
            SELECT *, lag(temp) OVER (PARTITION BY id ORDER BY arrival, seq) AS last_temp FROM arrivals)
        WHERE abs(temp - last_temp) > {c.JUMP_T}""",
    "temp_jump_zero_seed": RA + f"""SELECT id, arrival, seq, last_temp, temp FROM (
            SELECT *, coalesce(lag(temp) OVER (PARTITION BY id ORDER BY arrival, seq), 0.0) AS last_temp
            FROM arrivals)
        WHERE abs(temp - last_temp) > {c.JUMP_T}""",
    "temp_jump_map": RA + f"""SELECT arrival, seq,
            CASE WHEN abs(temp - l) > {c.JUMP_T} THEN id END AS jump_id,
            CASE WHEN abs(temp - l) > {c.JUMP_T} THEN l END AS jump_last_temp,
            CASE WHEN abs(temp - l) > {c.JUMP_T} THEN temp END AS jump_temp
        FROM (SELECT *, coalesce(lag(temp) OVER (PARTITION BY id ORDER BY arrival, seq), 0.0) AS l
              FROM arrivals)""",
    "rising_alarm": _RISING,
    "rising_first_alarm": _RUNS,
    "retract_avg": RA + f""", a AS (
            SELECT id, arrival, seq, sum(CAST(temp AS DECIMAL(18, 2))) OVER w AS s, count(*) OVER w AS n
            FROM arrivals WINDOW w AS {_BY_ARRIVAL}),
        b AS (SELECT *, lag(s) OVER w AS ps, lag(n) OVER w AS pn FROM a WINDOW w AS (PARTITION BY id ORDER BY arrival, seq)),
        d AS (SELECT *, CAST(s AS DOUBLE) / n AS new_avg, CAST(ps AS DOUBLE) / pn AS old_avg FROM b
              WHERE ps IS NULL OR ps * n <> s * pn)
        SELECT id, arrival, seq, true AS is_add, 1 AS change, {_steady("new_avg")} AS avg_temp FROM d
        UNION ALL
        SELECT id, arrival, seq, false AS is_add, 0 AS change, {_steady("old_avg")} AS avg_temp FROM d WHERE ps IS NOT NULL""",
    "retract_min": RA + f""", a AS (SELECT id, arrival, seq, min(temp) OVER {_BY_ARRIVAL} AS m FROM arrivals),
        b AS (SELECT *, lag(m) OVER (PARTITION BY id ORDER BY arrival, seq) AS p FROM a)
        SELECT id, arrival, seq, true AS is_add, 1 AS change, m AS temp FROM b WHERE p IS NULL OR p <> m
        UNION ALL
        SELECT id, arrival, seq, false AS is_add, 0 AS change, p AS temp FROM b WHERE p <> m""",
    "top2_retract": _TOP2_SEEN,
    "udf_hash_code": f"""SELECT seq, id, {_HASH} AS hash_code FROM (
            SELECT event_type || '_' || CAST(user_id AS VARCHAR) AS id, event_id AS seq FROM events)""",
    "udaf_avg": R + f"SELECT id, {_AVG} AS avg_temp FROM readings GROUP BY id",
    "udaf_avg_sql": R + f"SELECT id, {_AVG} AS avg_temp FROM readings GROUP BY id",
    "udtf_split": _SPLIT_PARTS,
    "udtf_split_sql": _SPLIT_PARTS,
    "split_edges": _EDGES,
    "top2": f"""WITH e AS (SELECT o_custkey AS id, o_totalprice AS temp, o_orderkey AS seq FROM orders),
        ranked AS (
            SELECT id, temp, CAST(row_number() OVER (PARTITION BY id ORDER BY temp DESC, seq) AS INTEGER) AS rank
            FROM e WHERE temp > {DOUBLE_MIN!r} AND NOT isnan(temp)),
        slots AS (SELECT k.id, r.rank FROM (SELECT DISTINCT id FROM e) k
                  CROSS JOIN (SELECT CAST(unnest([1, 2]) AS INTEGER) AS rank) r)
        SELECT s.id, coalesce(ranked.temp, {DOUBLE_MIN!r}) AS temp, s.rank
        FROM slots s LEFT JOIN ranked ON ranked.id = s.id AND ranked.rank = s.rank AND ranked.rank <= 2""",
    "outputs_once": R + f"""SELECT output, seq, id, temp FROM (
            SELECT 'high' AS output, * FROM readings WHERE temp > {c.SPLIT_T} AND NOT isnan(temp)
            UNION ALL SELECT 'low', * FROM readings WHERE NOT (temp > {c.SPLIT_T} AND NOT isnan(temp))
            UNION ALL SELECT 'side', * FROM readings WHERE temp < {c.SIDE_T})""",
    "mixed_elements": """SELECT event_id AS seq, CAST(pos AS INTEGER) AS pos,
            CASE pos WHEN 0 THEN CAST(user_id AS BIGINT) ELSE -1 END AS as_bigint, CASE pos WHEN 1 THEN value END AS as_double,
            CASE pos WHEN 2 THEN event_type END AS as_string
        FROM events, (SELECT unnest([0, 1, 2]) AS pos)""",
    "user_aggregate": R + f"SELECT id, {_AVG} AS avg_temp FROM readings GROUP BY id",
    "user_table_aggregate": f"""WITH e AS (SELECT o_custkey AS id, o_totalprice AS temp FROM orders),
        best AS (SELECT id, max(temp, 2) AS m FROM e GROUP BY id)
        SELECT id, coalesce(m[r], {DOUBLE_MIN!r}) AS temp, r AS rank
        FROM best, (SELECT CAST(unnest([1, 2]) AS INTEGER) AS r)""",
    "user_running_reduce": RA + f"""SELECT id, arrival, seq,
            max(timestamp) OVER w AS timestamp, min(temp) OVER w AS temp
        FROM arrivals WINDOW w AS {_BY_ARRIVAL}""",
    "keyed_latest": RA + """SELECT key, value FROM (
            SELECT CAST(temp AS VARCHAR) AS key, id AS value,
                   row_number() OVER (PARTITION BY CAST(temp AS VARCHAR) ORDER BY arrival DESC, seq DESC) AS rn
            FROM arrivals) WHERE rn = 1""",
    "document_json": R + """SELECT seq, '{"id":"' || id || '","temp":"' || CAST(temp AS VARCHAR)
            || '","time":"' || CAST(timestamp AS VARCHAR) || '"}' AS doc FROM readings""",
    "csv_payload": R + "SELECT seq, id || ',' || CAST(temp AS VARCHAR) AS value FROM readings",
    "kafka_payload": R + """SELECT seq, 'SensorReading(' || id || ',' || CAST(timestamp AS VARCHAR) || ','
            || CAST(temp AS VARCHAR) || ')' AS value FROM readings""",
    "console_lines": R + "SELECT 'result> ' || id || ',' || CAST(temp AS VARCHAR) AS line FROM readings",
    "positional_insert": R + "SELECT id, count(id) AS cnt FROM readings GROUP BY id",
    "epoch_millis_text": R + "SELECT seq, strftime(ts, '%a %b %d %H:%M:%S UTC %Y') AS text FROM readings",
}
