"""Rolling (per-record) and final keyed aggregates, and retract changelogs.

The table forms give one output per input row, in arrival order (``seq``,
the arrival number, unless told otherwise) inside the key, computed by the
skew-safe bucketed scan of ``tidemark.operators.ordered``. The stream forms (update output mode) emit
once per changed key per micro-batch instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import nan_min
from tidemark.operators import ordered

ORDER = ("seq",)


def rolling_count(df: DataFrame, key: str = "id", order: Sequence[str] = ORDER,
                  name: str = "count") -> DataFrame:
    """keyBy(k).sum(1) over (k, 1) pairs: the running count after each row."""
    return ordered.running(df, [key], order, {name: ("count", None)})


def rolling_reduce(df: DataFrame, key: str = "id", order: Sequence[str] = ORDER) -> DataFrame:
    """Running reduce (first id, max timestamp, min temp), one row per input.

    A NaN temp makes the minimum NaN from its row on, as ``Math.min`` does.
    """
    keep = list(dict.fromkeys([key, "timestamp", "temp", *order]))
    out = ordered.running(df.select(*keep).withColumnRenamed("timestamp", "_ts_in"), [key], order,
                          {"timestamp": ("max", "_ts_in"), "_min": ("min", "temp"), "_nan": ("max", F.isnan("temp"))})
    return out.select(key, *order, "timestamp", F.when(F.col("_nan"), F.lit(float("nan"))).otherwise(F.col("_min")).alias("temp"))


def reduce_final(df: DataFrame, key: str = "id", body: Sequence[Column] | None = None) -> DataFrame:
    """The reduce's last value per key: (id, max timestamp, min temp), or the aggregates of ``body``."""
    return df.groupBy(key).agg(*(body or [F.max("timestamp").alias("timestamp"), nan_min("temp").alias("temp")]))


def min_by_record(df: DataFrame, key: str = "id", value: str = "temp",
                  fields: Sequence[str] = ("timestamp", "temp", "seq"), order: Sequence[str] = ORDER) -> DataFrame:
    """minBy: the whole record holding the key's minimum; ties keep the earliest arrival.

    NaN counts as the greatest value, here and in the rolling form. Each task
    keeps one row per key before the shuffle (a partial group limit).
    """
    w = Window.partitionBy(key).orderBy(F.col(value), *[F.col(o) for o in order])
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select(key, *fields)


def rolling_min_by(df: DataFrame, key: str = "id", value: str = "temp",
                   order: Sequence[str] = ORDER) -> DataFrame:
    """Rolling minBy: after each row, the record holding the minimum so far.

    A running minimum over (value, order, record): structs compare field by
    field and NaN is the greatest double.
    """
    packed = F.struct(F.col(value).alias("v"), *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                      F.col("timestamp").alias("timestamp"))
    keep = list(dict.fromkeys([key, "timestamp", value, *order]))
    out = ordered.running(df.select(*keep), [key], order, {"_best": ("min", packed)})
    return out.select(key, *order, F.col("_best.timestamp").alias("min_timestamp"),
                      F.col("_best.v").alias(f"min_{value}"))


def group_count(df: DataFrame, key: str = "id", name: str = "count") -> DataFrame:
    """groupBy(id).select(id, id.count as count)."""
    return df.groupBy(key).agg(F.count(key).alias(name))


def retract_avg(df: DataFrame, key: str = "id", value: str = "temp",
                order: Sequence[str] = ORDER, name: str = "avg_temp") -> DataFrame:
    """Retract changelog of the per-key running average, in one ordered pass.

    The old average comes from the sum and count before the row. Averages of
    doubles: NaN stays NaN (equal to itself, as infinities are), and an unchanged average is recognised
    to a relative 1e-12, since sums before and after differ in rounding.
    """
    out = ordered.running(df.select(key, value, *order), [key], order,
                          {"_s": ("sum", value, True), "_c": ("count", None, True),
                           "_ps": ("sum", value, False), "_pc": ("count", None, False)})
    avg = (out.withColumn(name, F.col("_s") / F.col("_c"))
           .withColumn("_prev", F.when(F.col("_pc") > 0, F.col("_ps") / F.col("_pc")))
           .drop("_s", "_c", "_ps", "_pc", value))
    # only of finite averages: in Spark NaN <= NaN holds, and inf <= inf
    finite = F.abs(F.col("_prev") - F.col(name)) < F.lit(float("inf"))
    near = finite & (F.abs(F.col("_prev") - F.col(name)) <= F.abs(F.col(name)) * F.lit(1e-12))
    return _changelog(avg, name, key, order, unchanged=near | (F.col("_prev") == F.col(name)))


def retract_changelog(df: DataFrame, value: str, key: str = "id",
                      order: Sequence[str] = ORDER) -> DataFrame:
    """The retract stream of a per-key grouped value that changes per row.

    For each input row: the key's first row gives ``(true, new)``; a later
    row whose value differs gives ``(false, old)`` then ``(true, new)``; an
    unchanged value gives nothing. ``change`` orders the pair (0 retract,
    1 add). Works on any grouped value, e.g. a rolling count or reduce.
    """
    prev = ordered.previous(df.select(key, value, *order), [key], order, [value], k=1,
                            fmt="_prev")
    return _changelog(prev, value, key, order)


def _changelog(prev: DataFrame, value: str, key: str, order: Sequence[str], unchanged: Column | None = None) -> DataFrame:
    unchanged = F.col("_prev") == F.col(value) if unchanged is None else unchanged

    def entry(add: bool, v: str) -> Column:
        return F.struct(F.lit(add).alias("is_add"), F.lit(int(add)).alias("change"), F.col(v).alias(value))

    pairs = (F.when(F.col("_prev").isNull(), F.array(entry(True, value)))
             .when(~unchanged, F.array(entry(False, "_prev"), entry(True, value))))
    return prev.select(key, *order, F.inline(pairs))


def top2_retract(df: DataFrame, key: str = "id", value: str = "temp", order: Sequence[str] = ORDER) -> DataFrame:
    """Retract output of the top-2 table aggregate: after each row that changes
    a key's two highest values, the old (value, rank) rows are retracted
    (``change`` 0) and the new ones added (1).

    Values not above the most negative double, and NaN, are never taken; a
    missing rank shows the most negative double, but a key's first row
    retracts nothing. Both values are running maxima: the second is the
    highest of what fell short of, or was pushed out by, the first.
    """
    from tidemark.functions.udfs import DOUBLE_MIN

    taken = F.when((F.col(value) > F.lit(DOUBLE_MIN)) & ~F.isnan(value), F.col(value))
    base = df.select(key, *order, taken.alias("_v"))
    by = ordered.buckets(base, order)
    one = ordered.running(base, [key], order, {"_p1": ("max", "_v", False), "_n": ("count", None, False)}, by=by)
    out = F.when(F.col("_v") > F.col("_p1"), F.col("_p1")).otherwise(F.when(F.col("_p1").isNotNull(), F.col("_v")))
    two = ordered.running(one.withColumn("_out", out), [key], order,
                          {"_p2": ("max", "_out", False), "_t2": ("max", "_out", True)}, by=by)
    two = two.withColumn("_t1", F.greatest("_p1", "_v"))
    fill = lambda c: F.coalesce(F.col(c), F.lit(DOUBLE_MIN))
    changed = (F.col("_n") == 0) | ~(F.col("_p1").eqNullSafe(F.col("_t1")) & F.col("_p2").eqNullSafe(F.col("_t2")))

    def pair(add: bool, a: str, b: str) -> Column:
        return F.array(*[F.struct(F.lit(add).alias("is_add"), F.lit(int(add)).alias("change"), fill(c).alias(value), F.lit(r).alias("rank"))
                         for r, c in ((1, a), (2, b))])

    rows = F.when(F.col("_n") == 0, pair(True, "_t1", "_t2")).otherwise(F.concat(pair(False, "_p1", "_p2"), pair(True, "_t1", "_t2")))
    return two.where(changed).select(key, *order, F.inline(rows))
