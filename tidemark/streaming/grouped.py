"""Grouped results on streams with a user's aggregate: updates, changelogs, windows with lateness, processing-time windows.

The accumulator of a ``functions.aggregates.Aggregate`` is the keyed state, so
the class that runs over tables runs here unchanged. Rows of a micro-batch
are taken in the order given (arrival by default), so results do
not depend on where batches are cut unless they are emitted once a batch.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidemark.functions.aggregates import Aggregate, shipped

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARRIVAL = ("seq",)


def same_rows(old: list[tuple], new: list[tuple]) -> bool:
    """Equal rows, NaN being equal to NaN."""
    return len(old) == len(new) and all(a == b or (a != a and b != b) for x, y in zip(old, new) for a, b in zip(x, y))


def nearly(tolerance: float = 1e-12) -> Callable[[list[tuple], list[tuple]], bool]:
    """Equality up to a relative tolerance, for results that are sums of fractions."""
    def same(old: list[tuple], new: list[tuple]) -> bool:
        def equal(a, b) -> bool:
            return a == b or (a != a and b != b) or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= abs(b) * tolerance < math.inf)
        return len(old) == len(new) and all(equal(a, b) for x, y in zip(old, new) for a, b in zip(x, y))
    return same


def _names(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).names


def _types(ddl: str) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl).fields]


def _rows(rows: Iterator[pd.DataFrame], order: Sequence[str], values: Sequence[str]) -> tuple[pd.DataFrame, list[list]]:
    """The key's rows of the batch in order, and the aggregate's columns as Python values (a missing fraction is NaN, as pandas has it)."""
    pdf = pd.concat(list(rows), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)
    return pdf, [pa.array(pdf[v], from_pandas=False).to_pylist() if pdf[v].dtype != object else [None if x is None else x for x in pdf[v]] for v in values]


#: Which columns of a row are NaN, as bits: a pandas frame would hand them on as NULL.
NAN = "_nan"


def _frame(names: Sequence[str], rows: list[tuple]) -> pd.DataFrame:
    names = [*names, NAN]
    if not rows:
        return pd.DataFrame({n: pd.Series([], dtype=object) for n in names})
    return pd.DataFrame([(*r, sum(1 << i for i, x in enumerate(r) if x != x)) for r in rows], columns=names)


class _Acc(StatefulProcessor):
    """A processor whose state is an aggregate's accumulator per key."""

    def __init__(self, agg: Aggregate, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = ARRIVAL):
        self.agg, self.keys, self.values, self.order = shipped(agg), list(keys), list(values), list(order)
        self.out = _names(agg.OUT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.acc = handle.getValueState("acc", self.agg.ACC)

    def held(self) -> tuple | None:
        return tuple(self.acc.get()) if self.acc.exists() else None

    def close(self) -> None:
        pass


class Updates(_Acc):
    """After each micro-batch, the key's result rows (update mode)."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, columns = _rows(rows, self.order, self.values)
        acc = self.held() or self.agg.create()
        for one in zip(*columns):
            acc = self.agg.accumulate(acc, *one)
        self.acc.update(acc)
        yield _frame([*self.keys, *self.out], [(*key, *r) for r in self.agg.emit(acc)])


class Changelog(_Acc):
    """The retract stream of a grouped result, per row.

    A row that changes the key's result rows retracts the old ones (``change`` 0)
    and adds the new ones (1); the key's first row adds only. The old rows are
    those of the accumulator before, so that is all the state there is. With
    ``end`` (a key column: milliseconds at which a window ends) the state goes
    when the watermark passes the window; its last rows then stand.
    """

    def __init__(self, agg: Aggregate, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = ARRIVAL,
                 same: Callable[[list[tuple], list[tuple]], bool] = same_rows, end: str | None = None):
        super().__init__(agg, keys, values, order)
        self.same, self.end = same, None if end is None else self.keys.index(end)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf, columns = _rows(rows, self.order, self.values)
        acc, out = self.held(), []
        if acc is None and self.end is not None:
            self.handle.registerTimer(int(key[self.end]) - 1)
        old = None if acc is None else [tuple(r) for r in self.agg.emit(acc)]
        acc = self.agg.create() if acc is None else acc
        for place, one in zip(pdf[self.order].itertuples(index=False, name=None), zip(*columns)):
            acc = self.agg.accumulate(acc, *one)
            new = [tuple(r) for r in self.agg.emit(acc)]
            if old is None or not self.same(old, new):
                out += [(*key, *place, False, 0, *r) for r in old or []] + [(*key, *place, True, 1, *r) for r in new]
                old = new
        self.acc.update(acc)
        yield _frame([*self.keys, *self.order, "is_add", "change", *self.out], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.acc.clear()
        yield _frame([*self.keys, *self.order, "is_add", "change", *self.out], [])


class LatenessWindows(_Acc):
    """Event-time windows that fire when the watermark reaches their end, again for each later row, and go at end + lateness.

    The key's last column is the window's start in milliseconds. Output: the
    keys, the result and ``late`` (false for the firing at the end). State and timers
    of a window are gone once its lateness is over; rows that reach it later count nowhere.
    """

    def __init__(self, agg: Aggregate, keys: Sequence[str], values: Sequence[str], size_ms: int, lateness_ms: int, order: Sequence[str] = ARRIVAL):
        super().__init__(agg, keys, values, order)
        self.size, self.lateness = size_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.fired = handle.getValueState("fired", "fired boolean")

    def _firing(self, key, acc, late: bool) -> list[tuple]:
        return [(*key, *r, late) for r in self.agg.emit(acc)]

    def _out(self, rows: list[tuple]) -> pd.DataFrame:
        return _frame([*self.keys, *self.out, "late"], rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = int(key[-1]) + self.size - 1  # the window's last instant
        mark = timerValues.getCurrentWatermarkInMs() or 0
        if mark > 0 and mark >= last + self.lateness:
            yield self._out([])
            return
        _, columns = _rows(rows, self.order, self.values)
        acc, closed, out = self.held(), 0 < mark and mark >= last, []
        if acc is None:
            self.handle.registerTimer(last + self.lateness - 1)
            if not closed and self.lateness:
                self.handle.registerTimer(last - 1)
        if closed and not self.fired.exists():
            if acc is not None:  # its timer is due in this batch, but these rows come after the watermark
                out += self._firing(key, acc, False)
            self.fired.update((True,))
        acc = self.agg.create() if acc is None else acc
        for one in zip(*columns):
            acc = self.agg.accumulate(acc, *one)
            if closed:
                out += self._firing(key, acc, True)
        self.acc.update(acc)
        yield self._out(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, out = int(key[-1]) + self.size - 1, []
        acc = self.held()
        if acc is not None and not self.fired.exists():
            out = self._firing(key, acc, False)
            self.fired.update((True,))
        if expiredTimerInfo.getExpiryTimeInMs() >= last + self.lateness - 1:
            self.acc.clear()
            self.fired.clear()
        yield self._out(out)


class ProcessingTimeWindows(_Acc):
    """Tumbling windows of the time at which rows are processed (one clock value a micro-batch).

    Each window with rows fires once, when the clock has passed its end, and
    its state goes. Output: the keys, ``window_start_ms`` and the result.
    """

    def __init__(self, agg: Aggregate, keys: Sequence[str], values: Sequence[str], size_ms: int, order: Sequence[str] = ARRIVAL):
        super().__init__(agg, keys, values, order)
        self.size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start bigint", self.agg.ACC)

    def _out(self, rows: list[tuple]) -> pd.DataFrame:
        return _frame([*self.keys, "window_start_ms", *self.out], rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        _, columns = _rows(rows, self.order, self.values)
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.size
        known = self.open.containsKey((start,))
        acc = tuple(self.open.getValue((start,))) if known else self.agg.create()
        if not known:
            self.handle.registerTimer(start + self.size - 1)
        for one in zip(*columns):
            acc = self.agg.accumulate(acc, *one)
        self.open.updateValue((start,), acc)
        yield self._out([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() + 1 - self.size
        acc = tuple(self.open.getValue((start,)))
        self.open.removeKey((start,))
        yield self._out([(*key, start, *r) for r in self.agg.emit(acc)])


# ------------------------------------------------------------ streams

class Count(Aggregate):
    """The number of rows."""

    ACC = "n int"
    OUT = "cnt int"

    def create(self):
        return (0,)

    def accumulate(self, acc, *_):
        return (acc[0] + 1,)

    def merge(self, a, b):
        return (a[0] + b[0],)

    def emit(self, acc):
        return [(acc[0],)]


def _apply(df: DataFrame, processor: _Acc, extra_before: Sequence[str] = (), extra_after: Sequence[str] = (), mode: str = "append",
           time_mode: str = "None") -> DataFrame:
    p = processor
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    columns = list(dict.fromkeys([*p.keys, *p.order, *p.values]))
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in p.keys], *extra_before, *_types(p.agg.OUT), *extra_after, f"{NAN} bigint"])
    out = df.select(*columns).groupBy(*p.keys).transformWithStateInPandas(p, schema, mode, time_mode)

    def value(i: int, field) -> Column:
        if field.dataType.typeName() not in ("double", "float"):
            return F.col(field.name)
        return F.when(F.col(NAN).bitwiseAND(F.lit(1 << i)) != 0, F.lit(float("nan")).cast(field.dataType)).otherwise(F.col(field.name)).alias(field.name)

    return out.select(*[value(i, f) for i, f in enumerate(out.schema.fields[:-1])])


def update_stream(df: DataFrame, keys: Sequence[str], agg: Aggregate, values: Sequence[str], order: Sequence[str] = ARRIVAL) -> DataFrame:
    """A user aggregate (or table aggregate) on a stream: the changed keys' rows after each micro-batch."""
    return _apply(df, Updates(agg, keys, values, order), mode="update")


def changelog_stream(df: DataFrame, keys: Sequence[str], agg: Aggregate, values: Sequence[str], order: Sequence[str] = ARRIVAL,
                     same: Callable[[list[tuple], list[tuple]], bool] = same_rows) -> DataFrame:
    """The retract stream of any grouped result: keys, order columns, is_add, change, result."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return _apply(df, Changelog(agg, keys, values, order, same), [*[f"`{o}` {kinds[o]}" for o in order], "is_add boolean", "change int"])


def window_changelog_stream(df: DataFrame, keys: Sequence[str], agg: Aggregate, values: Sequence[str], size: str, delay: str,
                            order: Sequence[str] = ARRIVAL, same: Callable[[list[tuple], list[tuple]], bool] = same_rows) -> DataFrame:
    """The retract stream of a result grouped by tumbling event-time windows too (keys, window_end_ms, ...).

    State of a window goes when the watermark passes its end; Spark drops rows behind the watermark.
    """
    end = (F.unix_micros(F.window("ts", size)["end"]) / 1000).cast("bigint")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.withWatermark("ts", delay).withColumn("window_end_ms", end)
    processor = Changelog(agg, [*keys, "window_end_ms"], values, order, same, end="window_end_ms")
    return _apply(rows, processor, [*[f"`{o}` {kinds[o]}" for o in order], "is_add boolean", "change int"], time_mode="EventTime")


def lateness_stream(df: DataFrame, size_s: int, slide_s: int, delay_s: int, lateness_s: int, key: str = "id", agg: Aggregate | None = None,
                    values: Sequence[str] = (), order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Sliding event-time windows with allowed lateness and firings: (key, window_start_ms, result, late).

    The watermark advances between micro-batches (as Spark's does). Rows behind it still reach windows whose lateness
    is not over: the watermark is kept on a column that the
    stateful operator does not see, so Spark does not drop them before.
    """
    if size_s % slide_s:
        raise ValueError("size must be a multiple of slide")
    slide, size = slide_s * 1000, size_s * 1000
    t = F.floor(F.unix_micros("ts") / 1000).cast("bigint")
    starts = F.transform(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1)), lambda j: t - F.pmod(t, F.lit(slide)) - j * F.lit(slide))
    columns = list(dict.fromkeys([key, *order, *(values or order[:1])]))
    rows = df.withColumn("_mark", F.col("ts")).withWatermark("_mark", f"{delay_s} seconds").select(*columns, F.explode(starts).alias("window_start_ms"))
    processor = LatenessWindows(agg or Count(), [key, "window_start_ms"], values or order[:1], size, lateness_s * 1000, order)
    return _apply(rows, processor, extra_after=["late boolean"], time_mode="EventTime")


def processing_time_stream(df: DataFrame, size_s: int, keys: Sequence[str] = ("id",), agg: Aggregate | None = None, values: Sequence[str] = (),
                           order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Tumbling processing-time windows that fire: (keys, window_start_ms, result), each window once."""
    processor = ProcessingTimeWindows(agg or Count(), keys, values or order[:1], size_s * 1000, order)
    return _apply(df, processor, ["window_start_ms bigint"], time_mode="ProcessingTime")
