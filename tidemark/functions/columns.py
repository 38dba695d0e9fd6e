"""Column helpers shared by operators: time arithmetic, NaN rules."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ read as UTC wall clock.

    ``timestampdiff`` on NTZ values does not consult the session zone, so the
    result is the same on every cluster.
    """
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), col(ts))


def ntz_from_micros(us: Column | str) -> Column:
    """TIMESTAMP_NTZ holding the UTC wall clock of an epoch-microsecond count."""
    return F.timestamp_add("MICROSECOND", col(us), F.expr(EPOCH_NTZ))


def nan_min(c: Column | str) -> Column:
    """Minimum with the JVM's ``Math.min`` rule: NaN as soon as any value is NaN
    (Spark's ``min`` orders NaN above everything)."""
    c = col(c)
    return F.when(F.max(F.isnan(c)), F.lit(float("nan"))).otherwise(F.min(c))


def nan_min_over(c: Column | str, w: WindowSpec) -> Column:
    """``nan_min`` over a window."""
    c = col(c)
    return F.when(F.max(F.isnan(c)).over(w), F.lit(float("nan"))).otherwise(F.min(c).over(w))


def steady(c: Column | str) -> Column:
    """A double at six decimals, halves upwards within 1e-10: equal for sums taken in another order.

    For comparing results; not a rounding mode for users.
    """
    c = col(c)
    return F.floor(c * F.lit(1e6) + F.lit(0.5001)) / F.lit(1e6)


def above(c: Column | str, threshold: float) -> Column:
    """``c > threshold`` with JVM semantics: NaN is never above anything."""
    c = col(c)
    return (c > F.lit(threshold)) & ~F.isnan(c)
