"""Skew-safe ordered scans: running aggregates and bounded look-back frames.

A plain ``Window.partitionBy(key).orderBy(...)`` sorts a whole key in one
task; a key holding a third of the data would then run in a single task, and
a window with no key (a global watermark) always does. Here every ordered
operator works in *buckets* of the order, at every input size:

1. A row's bucket follows from the row alone: its place between the least
   and the greatest first order column, looked up in a fixed table of cells.
   The table comes from aggregates over that column (its range, then
   a count per cell). Cells that hold more than half a bucket's share are cut
   again, into cells of their own range, and where one value of the
   column fills a cell, by the next order column; so buckets hold about equal
   numbers of rows whatever the values are (one row in the year 9999), nothing
   is sampled, and every branch and every retry of a plan agrees.
2. A small table describes what each (key, bucket) needs from the buckets
   before it: a summary of each earlier bucket for running aggregates, or
   the last ``k`` rows for a ``k``-row frame, of keys that cross a boundary.
3. Those rows are added to their bucket as *context rows*, ordered first,
   and one window partitioned by ``(keys, bucket)`` does the work. Context
   rows are dropped afterwards.

A NULL key is a key of its own throughout. Rows whose first order column is
NULL form a bucket before all others. The first order column must be a
number, a date or a timestamp; ``order`` must be unique within a key.

Cost: two aggregates over the order columns (one more for each time that cells
are cut again), one hash exchange of the data for the windows, and the small
tables. One ``Buckets`` can be shared by all passes
of an operator over the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_micros
from tidemark.session import shuffle_partitions

BUCKET = "_b"
CTX = "_ctx"
ROWS_PER_BUCKET_CONF = "spark.tidemark.ordered.rowsPerBucket"
DEFAULT_ROWS_PER_BUCKET = 1_000_000
#: Cells of the whole range, at least (eight a bucket at least); buckets are runs of cells.
CELLS = 8_192
#: Cells that a full cell is cut into (fewer where very many cells are full), and how often cells are cut.
SUB_CELLS, MOST_SUB_CELLS, ROUNDS = 1_024, 1 << 20, 12

# running aggregate kinds: name -> (bucket summary, prefix over buckets, in-bucket window)
_KINDS = {
    "sum": (F.sum, F.sum, F.sum),
    "count": (F.sum, F.sum, F.sum),
    "max": (F.max, F.max, F.max),
    "min": (F.min, F.min, F.min),
}


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in names]


@dataclass(frozen=True)
class Buckets:
    """The bucket of a row as a column of its first order column, and how many there are."""

    column: Column
    count: int


def _place(df: DataFrame, name: str) -> Column:
    """The order column as a double (monotone, so equal places are all that can be lost).

    Fractions are placed by magnitude (so infinities have a place too), and NaN, which Spark orders last, after all.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return epoch_micros(name).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = F.col(name).cast("double")
        return F.when(F.isnan(c), F.lit(1e3)).otherwise(F.signum(c) * F.log1p(F.least(F.abs(c), F.lit(4e307))))
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"order column {name!r} must be a number, date or timestamp, not {kind.simpleString()}")


@dataclass
class _Node:
    """A range of one order column (by its place in the order) in cells of equal width; ``first`` is its first cell's row in the table."""

    column: int
    lo: float
    width: float
    cells: int
    first: int


class _Cells:
    """A tree of cells: one node for the whole range, and one below each cell that was cut again."""

    def __init__(self, places: list[Column], root: _Node):
        self.places, self.nodes = places, [root]
        self.below: dict[int, int] = {}  # cell -> node below it

    def size(self) -> int:
        return self.nodes[-1].first + self.nodes[-1].cells

    def add(self, cell: int, node: _Node) -> None:
        self.below[cell] = len(self.nodes)
        self.nodes.append(node)

    def in_order(self) -> list[int]:
        """The cells that are not cut, in the order of their rows."""
        out: list[int] = []
        stack = [iter(range(self.nodes[0].first, self.nodes[0].first + self.nodes[0].cells))]
        while stack:
            cell = next(stack[-1], None)
            if cell is None:
                stack.pop()
            elif cell in self.below:
                node = self.nodes[self.below[cell]]
                stack.append(iter(range(node.first, node.first + node.cells)))
            else:
                out.append(cell)
        return out

    def depth(self) -> int:
        own = {0: 1}
        at = {c: n for n, node in enumerate(self.nodes) for c in range(node.first, node.first + node.cells) if c in self.below}
        for cell, node in self.below.items():  # a node is added after the one above it
            own[node] = own[at[cell]] + 1
        return max(own.values())

    def column(self) -> Column:
        """The cell of a row: the root's, then that of the node below, until a cell is not cut."""
        def inside(column: Column, lo: Column, width: Column, cells: Column, first: Column) -> Column:
            at = F.floor((column - lo) / width)  # clamped before the cast: a row outside the range must not overflow
            return (first + F.greatest(F.least(F.coalesce(at, F.lit(0)), cells - 1), F.lit(0))).cast("int")

        root = self.nodes[0]
        out = inside(self.places[0], F.lit(root.lo), F.lit(root.width), F.lit(root.cells), F.lit(0))
        if not self.below:
            return out
        numbers = _literal([self.below.get(c, 0) for c in range(self.size())], "int")
        lo, width = (_literal([getattr(n, f) for n in self.nodes], "double") for f in ("lo", "width"))
        cells, first, which = (_literal([getattr(n, f) for n in self.nodes], "int") for f in ("cells", "first", "column"))
        places = F.array(*self.places)

        def step(cell: Column, _: Column) -> Column:
            node = F.get(numbers, cell)
            return F.when(node == 0, cell).otherwise(inside(F.get(places, F.get(which, node)), F.get(lo, node), F.get(width, node),
                                                            F.get(cells, node), F.get(first, node)))

        return F.aggregate(F.array_repeat(F.lit(0), self.depth() - 1), out, step)


def _literal(values: Sequence, kind: str) -> Column:
    """An array literal of any length (folded to one value by the optimizer)."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _one_value(name: str) -> Column:
    return F.min(name) == F.max(name)


def _orderable(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def buckets(df: DataFrame, order: Sequence[str], n: int | None = None) -> Buckets:
    """Cut the rows into buckets of about equal counts along ``order``.

    ``n`` buckets, by default one for each ``rowsPerBucket`` rows and at least
    the session's shuffle partitions. What reaches the driver is one row per
    cell that holds rows (at most eight a bucket or ``CELLS``, and ``MOST_SUB_CELLS`` of cut cells).
    Rows that are equal in all order columns that are numbers or times stay together.
    """
    names = [order[0], *[o for o in order[1:2] if _orderable(df, o)]]
    places = [_place(df, o) for o in names]
    spark = df.sparkSession
    ends = df.agg(F.min(places[0]).alias("lo"), F.max(places[0]).alias("hi"), F.count(places[0]).alias("n"),
                  F.min(places[-1]).alias("lo2"), F.max(places[-1]).alias("hi2"), _one_value(names[0]).alias("one")).first()
    total = ends["n"]
    if not total:
        return Buckets(F.when(places[0].isNull(), F.lit(-1)).otherwise(F.lit(0)), 1)
    per = int(spark.conf.get(ROWS_PER_BUCKET_CONF, str(DEFAULT_ROWS_PER_BUCKET)))
    n = n or max(shuffle_partitions(spark), -(-total // max(per, 1)))

    def node(ranges: list[tuple], one: bool, column: int, cells: int, first: int) -> _Node | None:
        # the second column tells rows apart only where the first has one value (equal doubles are not enough)
        for i in range(column, len(places) if one or column else 1):
            lo, hi = ranges[i]
            if lo is not None and hi > lo and (hi - lo) / cells > 0:
                return _Node(i, lo, (hi - lo) / cells, cells, first)
        return None

    root = node([(ends["lo"], ends["hi"]), (ends["lo2"], ends["hi2"])], ends["one"], 0, max(CELLS, 8 * n), 0)
    if root is None:
        return Buckets(F.when(places[0].isNull(), F.lit(-1)).otherwise(F.lit(0)), 1)
    if root.column:  # one value in the first column: the second tells rows apart
        root = _Node(0, ends["lo"], 1.0, 1, 0)
    tree, counts, known = _Cells(places, root), {}, 0
    for _ in range(ROUNDS):
        rows = df.where(places[0].isNotNull()).select(tree.column().alias("cell"), F.col(names[0]).alias("v"), *[p.alias(f"p{i}") for i, p in enumerate(places)])
        if known:
            rows = rows.where(F.col("cell") >= known)
        found = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), _one_value("v").alias("one"), *[f(f"p{i}").alias(f"{w}{i}") for i in range(len(places))
                                                                          for f, w in ((F.min, "lo"), (F.max, "hi"))]).collect()
        counts |= {r["cell"]: r["n"] for r in found}
        known = tree.size()
        full = [r for r in found if 2 * r["n"] * n > total]
        cells = max(16, min(SUB_CELLS, MOST_SUB_CELLS // max(1, len(full))))
        owner = {c: x for x in tree.nodes for c in range(x.first, x.first + x.cells)} if full else {}
        for r in sorted(full, key=lambda r: r["cell"]):
            below = node([(r[f"lo{i}"], r[f"hi{i}"]) for i in range(len(places))], r["one"], owner[r["cell"]].column, cells, tree.size())
            if below:
                tree.add(r["cell"], below)
        if tree.size() == known:
            break
    ids, before = [0] * tree.size(), 0
    for cell in tree.in_order():
        ids[cell] = min(n - 1, before * n // total)
        before += counts.get(cell, 0)
    return Buckets(F.when(places[0].isNull(), F.lit(-1)).otherwise(F.get(_literal(ids, "int"), tree.column())), n)


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs, as one join condition."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            aggs: dict[str, tuple[str, Column | str | None]], inclusive: bool = True,
            n: int | None = None, by: Buckets | None = None) -> DataFrame:
    """Add running aggregates per key along ``order``.

    ``aggs`` maps an output name to ``(kind, value)`` or ``(kind, value,
    inclusive)`` with kind one of ``sum count max min last``. Exclusive
    aggregates cover the rows strictly before each row (NULL for the first
    row of a key; 0 for count); ``inclusive`` is the default for all.
    """
    keys, order = list(keys), list(order)
    incl = {name: (spec[2] if len(spec) > 2 else inclusive) for name, spec in aggs.items()}
    by = by or buckets(df, order, n)
    r = df.withColumn(BUCKET, by.column)
    vcols = {}
    for i, (name, spec) in enumerate(aggs.items()):
        kind, value = spec[:2]
        v = f"_v{i}"
        if kind == "count":
            expr = F.lit(1).cast("bigint")
        elif kind == "last":
            expr = F.struct((F.col(value) if isinstance(value, str) else value).alias("x"))
        else:
            expr = F.col(value) if isinstance(value, str) else value
        vcols[name] = (kind, v)
        r = r.withColumn(v, expr)

    # per-bucket summaries and their exclusive prefix within the key
    summary = []
    for kind, v in vcols.values():
        if kind == "last":
            summary.append(F.max_by(F.col(v), F.struct(*_cols(order))).alias(v))
        else:
            summary.append(_KINDS[kind][0](F.col(v)).alias(v))
    b = r.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"), *summary)
    wb = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    prefix = [F.sum("_n").over(wb).alias("_n")]
    for kind, v in vcols.values():
        if kind == "last":
            prefix.append(F.last(F.col(v), ignorenulls=True).over(wb).alias(v))
        else:
            prefix.append(_KINDS[kind][1](F.col(v)).over(wb).alias(v))
    ctx = (b.select(*keys, BUCKET, *prefix)
           .where(F.col("_n").isNotNull()).drop("_n")
           .withColumn(CTX, F.lit(1)))
    for o in order:
        ctx = ctx.withColumn(o, F.lit(None).cast(df.schema[o].dataType))

    # one window per (key, bucket), context row first
    u = r.withColumn(CTX, F.lit(0)).unionByName(ctx, allowMissingColumns=True)
    w0 = Window.partitionBy(*keys, BUCKET).orderBy(F.col(CTX).desc(), *_cols(order))
    cols = []  # one select: one Window operator for all aggregates
    for name, (kind, v) in vcols.items():
        w = w0.rowsBetween(Window.unboundedPreceding, 0 if incl[name] else -1)
        if kind == "last":
            col = F.last(F.col(v), ignorenulls=True).over(w).getField("x")
        else:
            col = _KINDS[kind][2](F.col(v)).over(w)
            if kind == "count":
                col = F.coalesce(col, F.lit(0).cast("bigint"))
        cols.append(col.alias(name))
    drop = [BUCKET, CTX] + [v for _, v in vcols.values()]
    return u.select("*", *cols).where(F.col(CTX) == 0).drop(*drop)


def bucketed(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int,
             n: int | None = None, by: Buckets | None = None) -> DataFrame:
    """Rows with their bucket, and before each bucket of a key the key's last
    ``k`` rows as context (``_ctx`` = 1): a window over (keys, bucket) with
    frames of at most ``k`` rows back then sees what one over the key would."""
    keys, order = list(keys), list(order)
    by = by or buckets(df, order, n)
    r = df.withColumn(BUCKET, by.column)
    # the next buckets of each (key, bucket), and how many rows lie between:
    # only keys that cross a boundary have any
    ahead = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(1, k)
    edges = (r.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_next", F.collect_list(F.struct(F.col(BUCKET).alias("t"), F.col("_n").alias("n"))).over(ahead))
             .where(F.size("_next") > 0))
    targets = F.transform("_next", lambda x, i: F.struct(
        x["t"].alias("t"),
        F.aggregate(F.slice("_next", F.lit(1), i), F.lit(0).cast("bigint"), lambda s, y: s + y["n"]).alias("between")))
    edges = edges.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.col(BUCKET).alias("_eb"), targets.alias("_targets"))
    # the last k rows of every (key, bucket), pruned before the shuffle
    desc = Window.partitionBy(*keys, BUCKET).orderBy(*[F.col(o).desc() for o in order])
    tail = r.withColumn("_rd", F.row_number().over(desc)).where(F.col("_rd") <= k)
    ctx = (tail.join(edges, same(tail, edges, [*((c, f"_k{i}") for i, c in enumerate(keys)), (BUCKET, "_eb")]))
           .withColumn("_to", F.explode("_targets")).where(F.col("_to.between") + F.col("_rd") <= k)
           .withColumn(BUCKET, F.col("_to.t")).withColumn(CTX, F.lit(1)))
    return r.withColumn(CTX, F.lit(0)).unionByName(ctx.select(*r.columns, CTX))


def with_lookback(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int,
                  columns: dict[str, Callable[[WindowSpec], Column]],
                  n: int | None = None, by: Buckets | None = None) -> DataFrame:
    """Add columns computed over frames that reach at most ``k`` rows back.

    ``columns`` maps an output name to a function of the ordered window spec
    (partitioned per bucket, ordered by ``order``), e.g.
    ``lambda w: F.lag("temp", 1).over(w)`` or
    ``lambda w: F.avg("temp").over(w.rowsBetween(-2, 0))``.
    """
    u = bucketed(df, keys, order, k, n, by)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*_cols(list(order)))
    out = u.select("*", *[fn(w).alias(name) for name, fn in columns.items()])
    return out.where(F.col(CTX) == 0).drop(BUCKET, CTX)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             cols: Sequence[str], k: int = 1, default=None, n: int | None = None,
             fmt: str = "prev{j}_{c}", by: Buckets | None = None) -> DataFrame:
    """Add ``lag(c, j)`` for each column and ``j`` in ``1..k`` (skew-safe)."""
    spec = {}
    for c in cols:
        for j in range(1, k + 1):
            spec[fmt.format(j=j, c=c)] = (lambda w, c=c, j=j: F.lag(c, j, default).over(w))
    return with_lookback(df, keys, order, k, spec, n, by)
