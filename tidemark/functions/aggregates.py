"""User-defined aggregates, table aggregates and running folds, in two phases.

A user writes an ``Aggregate``: an accumulator (a tuple of a declared type),
how a row changes it, how two accumulators merge, and which rows it stands
for (one for an aggregate, any number for a table aggregate). Here it runs

- over groups (``aggregate``): every task folds its own rows into one
  accumulator a key, only those are shuffled, and a second pass merges them.
  A key that holds a third of all rows ships one accumulator a task;
- row by row along an order (``running``), as a parallel prefix over the
  ordered buckets: folds of the buckets, their prefix, a second pass that
  starts each bucket from its prefix. No key's rows meet in one task;
- on streams (``tidemark.streaming.grouped``), with the accumulator as state.

Python runs once a row, unless the user also overrides the batch forms
(``accumulate_many``, ``running_many``) with numpy or Arrow code. Where a
built-in aggregate can say it, that is faster.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.operators import ordered
from tidemark.operators.ordered import BUCKET, CTX

# tasks get these functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Keys that a task holds accumulators of before it hands them on.
HELD_KEYS = 50_000
#: Rows of an output batch.
BATCH_ROWS = 10_000


class Aggregate:
    """A user aggregate. ``ACC`` and ``OUT`` declare the accumulator and a result row as DDL.

    An accumulator is a tuple with a value for each column of ``ACC``. ``merge``
    must be associative with ``accumulate``: accumulating rows in two parts and
    merging gives what accumulating all of them gives. For ``aggregate`` it
    must also not depend on order; ``running`` keeps the order.
    """

    ACC: str
    OUT: str

    def create(self) -> tuple:
        """The accumulator of no rows."""
        raise NotImplementedError

    def accumulate(self, acc: tuple, *values) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def emit(self, acc: tuple) -> Iterable[tuple]:
        """The result rows of an accumulator."""
        raise NotImplementedError

    def accumulate_many(self, acc: tuple, columns: list[pa.Array]) -> tuple:
        """Accumulate rows given as columns, in order."""
        for values in zip(*[c.to_pylist() for c in columns]):
            acc = self.accumulate(acc, *values)
        return acc

    def running_many(self, acc: tuple, columns: list[pa.Array]) -> tuple[list[tuple], tuple]:
        """The (single) result row after each of some rows, and the accumulator after the last."""
        out = []
        for values in zip(*[c.to_pylist() for c in columns]):
            acc = self.accumulate(acc, *values)
            out.append(next(iter(self.emit(acc))))
        return out, acc


class Reduce(Aggregate):
    """A user's associative function of two rows, as an aggregate: ``f(a, b)`` gets and returns tuples of type ``schema``."""

    def __init__(self, f: Callable[[tuple, tuple], tuple], schema: str):
        self.f, self.OUT = f, schema
        self.ACC = f"row struct<{','.join(f'`{x.name}`: {x.dataType.simpleString()}' for x in _fields(schema))}>"
        self.names = [x.name for x in _fields(schema)]

    def create(self):
        return (None,)

    def _row(self, acc):
        row = acc[0]
        return tuple(row[n] for n in self.names) if isinstance(row, dict) else None if row is None else tuple(row)

    def accumulate(self, acc, *values):
        before = self._row(acc)
        return (values if before is None else self.f(before, values),)

    def merge(self, a, b):
        x, y = self._row(a), self._row(b)
        return (y if x is None else x if y is None else self.f(x, y),)

    def emit(self, acc):
        row = self._row(acc)
        return [] if row is None else [row]


def shipped(agg: Aggregate) -> Aggregate:
    """The aggregate, its class and functions being sent to executors by value (they may lack the user's module)."""
    for x in (*type(agg).__mro__, *vars(agg).values()):
        module = sys.modules.get(getattr(x, "__module__", None) or "")
        if callable(x) and module is not None and module.__name__ not in ("__main__", "builtins"):
            cloudpickle.register_pickle_by_value(module)
    return agg


# ------------------------------------------------------------ schemas and batches

def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def _schema(*fields: T.StructField) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if pa.types.is_struct(kind):
        names = [kind.field(i).name for i in range(kind.num_fields)]
        values = [None if v is None else v if isinstance(v, dict) else dict(zip(names, v)) for v in values]
    return pa.array(values, kind)


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else _column(c, schema.field(i).type) for i, c in enumerate(columns)], schema=schema)


def _values(batch: pa.RecordBatch, names: Sequence[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def _check_keys(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    fields = [df.schema[k] for k in keys]
    for f in fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.MapType)):
            raise TypeError(f"key {f.name!r} is a {f.dataType.simpleString()}; cast it to a type whose values compare exactly")
    return fields


def _runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) for stretches of equal keys of sorted batches; a key may come again in the next batch."""
    for batch in batches:
        if batch.num_rows:
            cols = [c.to_pylist() for c in _values(batch, keys)]
            rows = list(zip(*cols)) if cols else [()] * batch.num_rows
            start = 0
            for i in range(1, len(rows) + 1):
                if i == len(rows) or rows[i] != rows[start]:
                    yield rows[start], batch.slice(start, i - start)
                    start = i


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Array | None]]:
    """Each key of a batch with its rows' places, in order; without key columns all rows (None) are one group."""
    if not keys:
        yield (), None
        return
    names = [f"k{i}" for i in range(len(keys))]
    table = pa.Table.from_arrays([*_values(batch, keys), pa.array(range(batch.num_rows), pa.int32())], names=[*names, "row"])
    grouped = table.group_by(names, use_threads=False).aggregate([("row", "list")])
    rows = grouped["row_list"].combine_chunks()
    for i, key in enumerate(zip(*[grouped[k].to_pylist() for k in names])):
        yield key, rows[i].values


# ------------------------------------------------------------ over groups

def _fold_task(agg: Aggregate, keys: list[str], values: list[str], schema: pa.Schema):
    """Rows to one accumulator a key; a task with very many keys hands accumulators on as it goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def out():
            return _batch([*map(list, zip(*[(*k, *a) for k, a in held.items()]))], schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _values(batch, values)
            for key, own in _groups(batch, keys):
                acc = held.get(key)
                held[key] = agg.accumulate_many(agg.create() if acc is None else acc, columns if own is None else [c.take(own) for c in columns])
            if len(held) >= HELD_KEYS:
                yield out()
                held = {}
        if held:
            yield out()
    return run


def _merge_task(agg: Aggregate, keys: list[str], acc_names: list[str], schema: pa.Schema):
    """Accumulators sorted by key to result rows; holds one key's accumulator at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc, rows = None, None, []
        for key, part in _runs(batches, keys):
            for one in zip(*[c.to_pylist() for c in _values(part, acc_names)]):
                if acc is not None and key == current:
                    acc = agg.merge(acc, one)
                else:
                    if acc is not None:
                        rows += [(*current, *r) for r in agg.emit(acc)]
                    current, acc = key, one
            if len(rows) >= BATCH_ROWS:
                yield _batch([*map(list, zip(*rows))], schema)
                rows = []
        if acc is not None:
            rows += [(*current, *r) for r in agg.emit(acc)]
        if rows:
            yield _batch([*map(list, zip(*rows))], schema)
    return run


def aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregate, values: Sequence[str]) -> DataFrame:
    """(keys, the columns of ``agg.OUT``): a user aggregate or table aggregate of the columns ``values`` per group.

    A NULL key is a group. No rows give no groups. Keys must not be fractions.
    Two passes: a fold in each task, then one shuffle of accumulators, which
    are merged in key order.
    """
    keys, values, agg = list(keys), list(values), shipped(agg)
    key_fields = _check_keys(df, keys)
    inner = [T.StructField(f"_k{i}", f.dataType) for i, f in enumerate(key_fields)]
    accs = [T.StructField(f"_a{i}", f.dataType) for i, f in enumerate(_fields(agg.ACC))]
    partial, result = _schema(*inner, *accs), _schema(*key_fields, *_fields(agg.OUT))
    folded = df.select(*[F.col(k).alias(f.name) for k, f in zip(keys, inner)], *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    k, v, a = [f.name for f in inner], [f"_v{i}" for i in range(len(values))], [f.name for f in accs]
    folded = folded.mapInArrow(_fold_task(agg, k, v, to_arrow_schema(partial)), partial)
    merged = folded.repartition(*[F.col(c) for c in k]).sortWithinPartitions(*k) if k else folded.coalesce(1)
    return merged.mapInArrow(_merge_task(agg, k, a, to_arrow_schema(result)), result)


# ------------------------------------------------------------ along an order

def _bucket_fold(agg: Aggregate, keys: list[str], values: list[str], schema: pa.Schema):
    """Sorted rows to one accumulator for each (keys, bucket), in the rows' order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc, rows = None, None, []
        for key, part in _runs(batches, keys):
            if key != current:
                if current is not None:
                    rows.append((*current, *acc))
                current, acc = key, agg.create()
            acc = agg.accumulate_many(acc, _values(part, values))
            if len(rows) >= BATCH_ROWS:
                yield _batch([*map(list, zip(*rows))], schema)
                rows = []
        if current is not None:
            rows.append((*current, *acc))
            yield _batch([*map(list, zip(*rows))], schema)
    return run


def _prefix(agg: Aggregate, keys: list[str], acc_names: list[str], schema: pa.Schema):
    """Bucket accumulators sorted by (keys, bucket) to what stands before each bucket, for all but a key's first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc = None, None
        for batch in batches:
            rows = []
            names = [*keys, BUCKET, *acc_names]
            for row in zip(*[c.to_pylist() for c in _values(batch, names)]):
                key, bucket, own = row[:len(keys)], row[len(keys)], row[len(keys) + 1:]
                if key == current:
                    rows.append((*key, bucket, *acc))
                    acc = agg.merge(acc, own)
                else:
                    current, acc = key, own
            if rows:
                yield _batch([*map(list, zip(*rows))], schema)
    return run


def _running_rows(agg: Aggregate, keys: list[str], values: list[str], acc_names: list[str], kept: list[str], schema: pa.Schema):
    """Rows sorted by (keys, bucket, context first, order) to the rows with the result after each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc = None, None
        for key, part in _runs(batches, keys):
            if key != current:
                current, acc = key, agg.create()
            if part.column(part.schema.get_field_index(CTX))[0].as_py():
                acc = tuple(c[0].as_py() for c in _values(part, acc_names))
                part = part.slice(1)
            if part.num_rows:
                out, acc = agg.running_many(acc, _values(part, values))
                yield _batch([*_values(part, kept), *map(list, zip(*out))], schema)
    return run


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg: Aggregate, values: Sequence[str],
            keep: Sequence[str] | None = None, n: int | None = None, by: ordered.Buckets | None = None) -> DataFrame:
    """The rows (columns ``keep``, by default keys and order) with the columns of ``agg.OUT`` after each row, per key along ``order``.

    ``agg.emit`` gives one row here. A NULL key is a key of its own. What the
    driver holds is the bucket table; a task holds one accumulator.
    """
    keys, order, values, agg = list(keys), list(order), list(values), shipped(agg)
    keep = list(keep or dict.fromkeys([*keys, *order]))
    _check_keys(df, keys)
    by = by or ordered.buckets(df, order, n)
    rows = df.select(*[F.col(c) for c in keep], *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                     *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)], by.column.alias(BUCKET))
    k, o, v = ([f"_{c}{i}" for i in range(len(x))] for c, x in (("k", keys), ("o", order), ("v", values)))
    group = [*k, BUCKET]
    accs = [T.StructField(f"_a{i}", f.dataType) for i, f in enumerate(_fields(agg.ACC))]
    a = [f.name for f in accs]
    folded_schema = _schema(*[rows.schema[c] for c in group], *accs)
    arrow = to_arrow_schema(folded_schema)

    def dealt(x: DataFrame, by_cols: list[str], sort: list[str | Column]) -> DataFrame:
        return x.repartition(*[F.col(c) for c in by_cols]).sortWithinPartitions(*sort)

    folds = dealt(rows.select(*group, *o, *v), group, [*group, *o]).mapInArrow(_bucket_fold(agg, group, v, arrow), folded_schema)
    folds = dealt(folds, k, group) if k else folds.coalesce(1).sortWithinPartitions(*group)  # a row a key and bucket
    before = folds.mapInArrow(_prefix(agg, k, a, arrow), folded_schema).withColumn(CTX, F.lit(1))
    both = rows.withColumn(CTX, F.lit(0)).unionByName(before, allowMissingColumns=True)
    result = _schema(*[df.schema[c] for c in keep], *_fields(agg.OUT))
    return dealt(both, group, [*group, F.col(CTX).desc(), *o]).mapInArrow(
        _running_rows(agg, group, v, a, keep, to_arrow_schema(result)), result)


# ------------------------------------------------------------ the two that the queries use

class AvgTemp(Aggregate):
    """The average as a user would write it: accumulator (sum, count), result sum / count."""

    ACC = "sum double, count bigint"
    OUT = "avg_temp double"

    def create(self):
        return 0.0, 0

    def accumulate(self, acc, temp):
        return (acc[0] + temp, acc[1] + 1) if temp is not None else acc

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def emit(self, acc):
        return [(acc[0] / acc[1] if acc[1] else None,)]


class Top2Temp(Aggregate):
    """The two highest values as a table aggregate: rows (temp, rank), the most negative double where there is none."""

    ACC = "highest double, second double"
    OUT = "temp double, rank int"
    # Fixed value: the most negative finite double stands for "none yet".
    NONE = -1.7976931348623157e308

    def create(self):
        return self.NONE, self.NONE

    def accumulate(self, acc, temp):
        if temp is None:
            return acc
        high, second = acc
        return (temp, high) if temp > high else (high, temp) if temp > second else acc

    def merge(self, a, b):
        return self.accumulate(self.accumulate(a, b[0]), b[1])

    def emit(self, acc):
        return [(acc[0], 1), (acc[1], 2)]


def reduce_reading(a: tuple, b: tuple) -> tuple:
    """A user's reduce function of two readings (id, timestamp, temp): first id, later timestamp, lower temp (NaN if either is)."""
    low = float("nan") if a[2] != a[2] or b[2] != b[2] else min(a[2], b[2])
    return a[0], max(a[1], b[1]), low
