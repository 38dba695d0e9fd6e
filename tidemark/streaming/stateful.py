"""Keyed state and timers on streams: ``transformWithStateInPandas`` processors.

Spark hands each processor one key's rows of a micro-batch (Arrow batches
as pandas frames) and its state; the stream is shuffled by key, state lives
in the RocksDB store and is checkpointed with the query. Row order inside a
micro-batch is not guaranteed, so every processor sorts: by arrival number
(``seq``) where the reference sees rows as they come, so the answer does not
depend on where batches are cut, and by ``(ts, seq)`` in event time.

Each processor has a table twin in ``tidemark.operators`` (same output for
the same rows once the stream is flushed); tests check the pairs agree.
Use ``apply(stream, key, processor)`` to run one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.udfs import DOUBLE_MIN
from tidemark.operators.alerts import ALARM_PREFIX, ALARM_SUFFIX

US = 1_000_000
ARRIVAL = ("seq",)
EVENT_TIME = ("ts", "seq")


def _sorted(rows: Iterator[pd.DataFrame], by=ARRIVAL) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(list(by), kind="stable", ignore_index=True)


def _micros(ts: pd.Series) -> np.ndarray:
    """Epoch microseconds of a timestamp column (tz-aware or naive UTC)."""
    s = pd.to_datetime(ts)
    if getattr(s.dt, "tz", None) is not None:
        s = s.dt.tz_convert("UTC").dt.tz_localize(None)
    return s.astype("datetime64[us]").astype("int64").to_numpy()


def apply(stream: DataFrame, key: str, processor: StatefulProcessor, output_schema: str,
          output_mode: str = "append", time_mode: str = "None",
          event_time_col: str | None = None) -> DataFrame:
    """Run ``processor`` per key of ``stream`` (``transformWithStateInPandas``)."""
    g = stream.groupBy(key)
    if event_time_col:
        return g.transformWithStateInPandas(processor, output_schema, output_mode, time_mode,
                                            eventTimeColumnName=event_time_col)
    return g.transformWithStateInPandas(processor, output_schema, output_mode, time_mode)


# ------------------------------------------------------------------ jumps

class TempJump(StatefulProcessor):
    """Emit (id, last_temp, temp) when |temp - last| > threshold.

    ``seed_zero``: unset state reads as 0.0 (the flatMap class); otherwise
    the key's first row only seeds the state. ``as_map``: one output per
    input, NULLs for non-jumps (the map class); output then carries ``seq``.
    """

    SCHEMA = "id string, last_temp double, temp double, seq bigint"

    def __init__(self, threshold: float = 10.0, seed_zero: bool = False, as_map: bool = False):
        self.threshold, self.seed_zero, self.as_map = threshold, seed_zero, as_map

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "temp double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        temps = pdf["temp"].to_numpy(dtype="float64")
        if self.last.exists():
            first = self.last.get()[0]
        else:
            first = 0.0 if self.seed_zero else np.nan
        prev = np.concatenate([[first], temps[:-1]])
        with np.errstate(invalid="ignore"):
            jump = np.abs(temps - prev) > self.threshold
        jump &= ~np.isnan(temps) & ~np.isnan(prev)
        self.last.update((float(temps[-1]),))
        if self.as_map:
            yield pd.DataFrame({"id": np.where(jump, key[0], None), "last_temp": np.where(jump, prev, np.nan),
                                "temp": np.where(jump, temps, np.nan), "seq": pdf["seq"].to_numpy()})
        else:
            yield pd.DataFrame({"id": key[0], "last_temp": prev[jump], "temp": temps[jump],
                                "seq": pdf["seq"].to_numpy()[jump]})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ row frames

class LastRows(StatefulProcessor):
    """Rows-based frames on a stream: for each row, the key's last ``n`` rows
    (the row included). Emits count, average temp, max timestamp and
    min temp (NaN if any is): OVER ``n-1`` PRECEDING and the count window
    with the reduce function. List state holds at most ``n-1`` rows."""

    SCHEMA = "id string, seq bigint, cnt bigint, avg_temp double, max_timestamp bigint, min_temp double"

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("tail", "temp double, timestamp bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        tail = list(self.buf.get()) if self.buf.exists() else []
        temps = [t for t, _ in tail] + pdf["temp"].tolist()
        stamps = [s for _, s in tail] + pdf["timestamp"].tolist()
        k, n = len(tail), self.n
        idx = np.arange(k, len(temps))
        cnt = np.minimum(idx + 1, n)
        # one column a place in the frame: at most n additions, each frame on its own
        padded = np.concatenate([np.full(n - 1, np.nan), np.asarray(temps, dtype="float64")])
        frames = np.lib.stride_tricks.sliding_window_view(padded, n)[k:]
        inside = np.arange(n)[None, :] >= n - cnt[:, None]
        avg = np.where(inside, frames, 0.0).sum(axis=1) / cnt
        low = np.where(inside, frames, np.inf).min(axis=1)  # NaN wins, as in the table form
        roll_s = pd.Series(stamps, dtype="int64").rolling(n, min_periods=1)
        keep = max(0, len(temps) - (n - 1))
        self.buf.put(list(zip(temps[keep:], stamps[keep:])))
        yield pd.DataFrame({"id": key[0], "seq": pdf["seq"].to_numpy(), "cnt": cnt.astype("int64"),
                            "avg_temp": avg, "max_timestamp": roll_s.max().to_numpy()[k:].astype("int64"),
                            "min_temp": low})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ sessions

class Sessions(StatefulProcessor):
    """Event-time session windows with the reference's merge rule: each row
    opens ``[t, t + gap)`` and sessions whose windows touch are merged (Spark's
    ``session_window`` splits at exactly the gap). Open sessions of a key are
    kept in list state; a batch's times and the open sessions merge in one sorted
    pass, and state and timers are written once a batch. A session is emitted when the
    watermark passes its last instant (``end - 1 ms``); a row whose own window
    already closed is dropped, as the reference drops it without lateness.
    Output (id, session_start_ms, session_end_ms, cnt), end exclusive.
    """

    SCHEMA = "id string, session_start_ms bigint, session_end_ms bigint, cnt bigint"

    def __init__(self, gap_s: int):
        self.gap = gap_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start bigint, last bigint, cnt bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = np.sort(np.concatenate([_micros(pdf["ts"]) // 1000 for pdf in rows]))
        wm = timerValues.getCurrentWatermarkInMs()
        if wm is not None and wm > 0:
            times = times[times + self.gap - 1 > wm]  # the rest's windows closed already
        before = [tuple(x) for x in self.open.get()] if self.open.exists() else []
        # runs of the batch's times that touch, then runs of those and the open sessions
        heads = np.flatnonzero(np.append(True, np.diff(times) > self.gap)) if len(times) else np.array([], dtype=int)
        ends = np.append(heads[1:], len(times))
        merged: list[tuple] = []
        for start, last, cnt in sorted(before + [(int(times[i]), int(times[j - 1]), int(j - i)) for i, j in zip(heads, ends) if j > i]):
            if merged and start <= merged[-1][1] + self.gap:
                s0, l0, c0 = merged[-1]
                merged[-1] = (s0, max(l0, last), c0 + cnt)
            else:
                merged.append((start, last, cnt))
        old, new = {x[1] for x in before}, {x[1] for x in merged}
        for last in old - new:
            self.handle.deleteTimer(last + self.gap - 1)
        for last in new - old:
            self.handle.registerTimer(last + self.gap - 1)
        if merged:
            self.open.put(merged)
        yield pd.DataFrame({"id": pd.Series([], dtype="object"), "session_start_ms": pd.Series([], dtype="int64"),
                            "session_end_ms": pd.Series([], dtype="int64"), "cnt": pd.Series([], dtype="int64")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        sessions = [tuple(x) for x in self.open.get()] if self.open.exists() else []
        done = [x for x in sessions if x[1] + self.gap - 1 == due]
        rest = [x for x in sessions if x[1] + self.gap - 1 != due]
        if rest:
            self.open.put(rest)
        else:
            self.open.clear()
        yield pd.DataFrame({"id": pd.Series([key[0]] * len(done), dtype="object"),
                            "session_start_ms": pd.Series([x[0] for x in done], dtype="int64"),
                            "session_end_ms": pd.Series([x[1] + self.gap for x in done], dtype="int64"),
                            "cnt": pd.Series([x[2] for x in done], dtype="int64")})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ alarm

class RisingAlarm(StatefulProcessor):
    """The rising-temperature alarm with a timer per key.

    ``time_mode="ProcessingTime"`` is the reference: the timer is armed at
    wall-clock now + D. ``"EventTime"`` arms at the row's event time + D;
    a timer due at or before a row's time fires before that row is applied
    (as in the table form), the rest fire when the watermark passes them.
    Last temperature starts at 0.0. Output (id, alarm_ts ms, message).
    """

    SCHEMA = "id string, alarm_ms bigint, message string"

    def __init__(self, timer_s: int, time_mode: str = "EventTime"):
        self.timer_ms = timer_s * 1000
        self.event_time = time_mode == "EventTime"
        self.message = f"{ALARM_PREFIX}{timer_s}{ALARM_SUFFIX}"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_temp", "temp double")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, EVENT_TIME)
        last = self.last.get()[0] if self.last.exists() else 0.0
        timer = self.timer.get()[0] if self.timer.exists() else None
        fired = []
        now = timerValues.getCurrentProcessingTimeInMs()
        ms = _micros(pdf["ts"]) // 1000
        for t, v in zip(ms, pdf["temp"].to_numpy(dtype="float64")):
            if self.event_time and timer is not None and t >= timer:
                fired.append(timer)
                self.handle.deleteTimer(timer)
                timer = None
            if v > last and timer is None:
                timer = int((t if self.event_time else now) + self.timer_ms)
                self.handle.registerTimer(timer)
            elif v < last and timer is not None:
                self.handle.deleteTimer(timer)
                timer = None
            if not np.isnan(v):
                last = float(v)
            else:
                last = float("nan")
        self.last.update((last,))
        if timer is None:
            self.timer.clear()
        else:
            self.timer.update((timer,))
        yield pd.DataFrame({"id": key[0], "alarm_ms": fired, "message": self.message})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        yield pd.DataFrame({"id": [key[0]], "alarm_ms": [expiredTimerInfo.getExpiryTimeInMs()],
                            "message": [self.message]})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ state tour

class StateTour(StatefulProcessor):
    """Value, list, map and reducing state in one processor.

    Value: last temp. List: one entry appended per row. Map: temp by
    timestamp text. Reducing: (max timestamp, min temp) folded on add.
    Emits the state after each micro-batch (update mode).
    """

    SCHEMA = "id string, last_temp double, list_len bigint, map_size bigint, max_timestamp bigint, min_temp double"
    # Fixed value: the entry the reference appends to its list state per row.
    LIST_ENTRY = "haha"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("last", "temp double")
        self.items = handle.getListState("items", "item string")
        self.by_ts = handle.getMapState("by_ts", "ts string", "temp double")
        self.reduced = handle.getValueState("reduced", "max_timestamp bigint, min_temp double, list_len bigint, map_size bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        temps, stamps = pdf["temp"].to_numpy(dtype="float64"), pdf["timestamp"].to_numpy()
        mx, mn, n_items, n_map = self.reduced.get() if self.reduced.exists() else (None, None, 0, 0)
        self.value.update((float(temps[-1]),))
        self.items.appendList([(self.LIST_ENTRY,)] * len(pdf))  # one call a batch
        for ts, temp in dict(zip(stamps.tolist(), temps.tolist())).items():  # the last temp of each time
            n_map += not self.by_ts.containsKey((str(ts),))
            self.by_ts.updateValue((str(ts),), (temp,))
        mx = int(stamps.max()) if mx is None else max(mx, int(stamps.max()))
        mn = float(temps.min()) if mn is None else float(np.minimum(mn, temps.min()))
        n_items += len(pdf)
        self.reduced.update((mx, mn, n_items, n_map))
        yield pd.DataFrame({"id": [key[0]], "last_temp": [float(temps[-1])], "list_len": [n_items],
                            "map_size": [n_map], "max_timestamp": [mx], "min_temp": [mn]})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ top 2

class Top2(StatefulProcessor):
    """The top-2 table aggregate on a stream: state (highest, second), both
    ranks emitted after each micro-batch (update mode), the most negative
    double filling a missing rank; NaN and -inf are never taken."""

    SCHEMA = "id string, temp double, rank int"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "highest double, second double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hi, second = self.acc.get() if self.acc.exists() else (DOUBLE_MIN, DOUBLE_MIN)
        t = np.concatenate([pdf["temp"].to_numpy(dtype="float64") for pdf in rows] + [[hi, second]])
        t = t[(t > DOUBLE_MIN) & ~np.isnan(t)]  # NaN and -inf are never taken
        best = np.sort(t)[::-1][:2]
        hi = float(best[0]) if len(best) > 0 else DOUBLE_MIN
        second = float(best[1]) if len(best) > 1 else DOUBLE_MIN
        self.acc.update((hi, second))
        yield pd.DataFrame({"id": [key[0], key[0]], "temp": [hi, second], "rank": [1, 2]})

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ changelog

class RetractAvg(StatefulProcessor):
    """Retract changelog of the per-key running average, per record: state
    (sum, count); emits (false, old) and (true, new) pairs."""

    SCHEMA = "id string, seq bigint, is_add boolean, change int, avg_temp double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "s double, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        s, n = self.acc.get() if self.acc.exists() else (0.0, 0)
        sums = np.cumsum(np.concatenate([[s], pdf["temp"].to_numpy(dtype="float64")]))
        counts = n + np.arange(len(sums))
        with np.errstate(invalid="ignore"):
            avg = sums / counts  # before the first row: 0 / 0
            old, new = avg[:-1], avg[1:]
            near = np.isfinite(old - new) & (np.abs(old - new) <= np.abs(new) * 1e-12)
        first = counts[:-1] == 0
        same = near | (old == new) | (np.isnan(old) & np.isnan(new))
        changed = ~first & ~same
        seq = pdf["seq"].to_numpy()
        adds = pd.DataFrame({"seq": seq[first | changed], "is_add": True, "change": 1,
                             "avg_temp": new[first | changed]})
        retracts = pd.DataFrame({"seq": seq[changed], "is_add": False, "change": 0, "avg_temp": old[changed]})
        self.acc.update((float(sums[-1]), int(counts[-1])))
        out = pd.concat([retracts, adds], ignore_index=True)
        out.insert(0, "id", key[0])
        yield out

    def close(self) -> None:
        pass
