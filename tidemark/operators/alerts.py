"""Keyed alerts: temperature jumps and the rising-temperature alarm.

Jumps compare each reading with the one that arrived before it (order
``seq``, the arrival number); the rising alarm works in event time (order
``(ts, seq)``). The stream forms live in ``tidemark.streaming.stateful``.

Rising alarm, event-time form. Per key the state is the last temperature
(0.0 before the first row) and an optional timer. For each row at time
``t``: a timer due at or before ``t`` fires first (alarm at the timer's time)
and is cleared; then a strict rise with no timer set arms one at ``t + D``,
a strict fall deletes it, an equal value does nothing. A timer still set
after the key's last row fires too.

Cut the key's rows into *runs* at strict falls (the fall row closes its
run). Inside a run only rises and equal values occur, so the timers armed
are a greedy chain: ``a1`` = the first rise, ``a(m+1)`` = the first rise at
or after ``a(m) + D``. Every armed timer fires except possibly the last, which
the closing fall at ``tf`` deletes unless ``tf >= a + D``. A run whose rises
all lie within ``D`` of the first arms once and needs no chain.

The chain is sequential, but each rise has one successor ``next(i)`` (an
as-of lookup), so the chain is the path from the run's first rise in a
forest. It is found by pointer jumping: ``J0 = next``,
``J(r+1) = J(r) o J(r)``, and the set of reached rises doubles its distance
range each round, ``Q(r+1) = Q(r) + J(r)(Q(r))``. A rise is named by (key,
run, seq), a NULL key is a key of its own, and rounds stop when no chain
reaches further, after about log2(longest chain) of them. The rule is the
same at every size; no key or run is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import epoch_micros, ntz_from_micros
from tidemark.operators import ordered
from tidemark.session import checkpoint_dir

ARRIVAL = ("seq",)
EVENT_ORDER = ("ts", "seq")
US = 1_000_000

# The alarm text of the reference, "<prefix><seconds><suffix>".
ALARM_PREFIX = "温度连续上升"
ALARM_SUFFIX = "秒"


def _not_nan(c):
    return ~F.isnan(F.col(c))


def temp_jump(df: DataFrame, threshold: float = 10.0, seed_zero: bool = False, key: str = "id",
              order: Sequence[str] = ARRIVAL) -> DataFrame:
    """(id, last temp, temp) where |temp - last temp| > threshold.

    The key's first row only seeds the state, unless ``seed_zero``: then the
    unset state reads as 0.0 and the first row is compared with it.
    """
    prev = ordered.previous(df.select(key, "temp", *order), [key], order, ["temp"], k=1,
                            default=0.0 if seed_zero else None, fmt="last_temp")
    jump = (F.abs(F.col("temp") - F.col("last_temp")) > F.lit(threshold)) & _not_nan("temp") & _not_nan("last_temp")
    return prev.where(jump).select(key, *order, "last_temp", "temp")


def temp_jump_map(df: DataFrame, threshold: float = 10.0, key: str = "id",
                  order: Sequence[str] = ARRIVAL) -> DataFrame:
    """One output per input: the zero-seeded jump, or NULLs for a non-jump."""
    prev = ordered.previous(df.select(key, "temp", *order), [key], order, ["temp"], k=1,
                            default=0.0, fmt="_last")
    jump = (F.abs(F.col("temp") - F.col("_last")) > F.lit(threshold)) & _not_nan("temp") & _not_nan("_last")
    return prev.select(*order,
                       F.when(jump, F.col(key)).alias("jump_id"),
                       F.when(jump, F.col("_last")).alias("jump_last_temp"),
                       F.when(jump, F.col("temp")).alias("jump_temp"))


def _runs(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``rise``/``fall`` flags (vs the last temp, 0.0 at first) and
    ``run`` = number of falls strictly before the row in its key."""
    base = df.select(key, "temp", *order)
    by = ordered.buckets(base, order)
    prev = ordered.previous(base, [key], order, ["temp"], k=1, default=0.0, fmt="_last", by=by)
    flagged = (prev.withColumn("rise", (F.col("temp") > F.col("_last")) & _not_nan("temp") & _not_nan("_last"))
               .withColumn("fall", (F.col("temp") < F.col("_last")) & _not_nan("temp") & _not_nan("_last"))
               .withColumn("_t", epoch_micros(order[0])))
    out = ordered.running(flagged, [key], order,
                          {"run": ("sum", F.col("fall").cast("bigint"))}, inclusive=False, by=by)
    return out.withColumn("run", F.coalesce(F.col("run"), F.lit(0).cast("bigint")))


def _join_runs(left: DataFrame, right: DataFrame, key: str, on: Sequence[tuple[str, str]] = (), how: str = "inner") -> DataFrame:
    """Null-safe join on key and run (and further pairs); the right side's copies of key and run are dropped."""
    right = right.withColumnsRenamed({key: "_rk", "run": "_rr"})
    return left.join(right, ordered.same(left, right, [(key, "_rk"), ("run", "_rr"), *on]), how).drop("_rk", "_rr")


def _arm_candidates(rises: DataFrame, key: str, d: int) -> DataFrame:
    """Rises (key, run, seq, _t) with ``nxt``: the seq of the first rise of the same run at or
    after ``t + D`` (NULL if none). As-of lookup by a running min in reverse."""
    targets = rises.select(key, "run", F.col("_t").alias("_time"), F.lit(1).alias("_kind"), "seq", "_t",
                           F.struct(F.col("_t").alias("t"), F.col("seq").alias("s")).alias("_tgt"))
    probes = rises.select(key, "run", (F.col("_t") + F.lit(d)).alias("_time"), F.lit(0).alias("_kind"), "seq", "_t",
                          F.lit(None).cast("struct<t:bigint,s:bigint>").alias("_tgt"))
    u = (targets.unionByName(probes)
         .withColumn("_nt", -F.col("_time")).withColumn("_nk", -F.col("_kind")).withColumn("_ns", -F.col("seq")))
    found = ordered.running(u, [key, "run"], ["_nt", "_nk", "_ns"], {"_nx": ("min", "_tgt")})
    return found.where(F.col("_kind") == 0).select(key, "run", "seq", "_t", F.col("_nx.s").alias("nxt"))


def _chain(nodes: DataFrame, starts: DataFrame, key: str, max_rounds: int = 64) -> DataFrame:
    """(key, run, seq) on the pointer path from each start (pointer jumping).

    Each round is cut with a reliable checkpoint, so a lost executor repeats one round at most.
    """
    jump = nodes.select(key, "run", "seq", "nxt")
    reached = starts.select(key, "run", "seq")
    for _ in range(max_rounds):
        steps = jump.where("nxt is not null").select(key, "run", F.col("seq").alias("_from"), "nxt")
        hop = _join_runs(reached, steps, key, [("seq", "_from")]).select(key, "run", F.col("nxt").alias("seq")).checkpoint()
        if hop.isEmpty():
            return reached
        reached = reached.unionByName(hop)
        jump = _join_runs(jump, steps.withColumnRenamed("nxt", "_then"), key, [("nxt", "_from")], "left").select(
            key, "run", "seq", F.col("_then").alias("nxt")).checkpoint()
    raise RuntimeError("rising alarm chain did not converge")


def rising_alarm(df: DataFrame, timer_s: int, key: str = "id", order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Every alarm of the rising-temperature timer: (id, alarm_ts, message).

    ``seq`` must be unique within a key. The flagged rows are written once (a
    reliable checkpoint), since every branch reads them.
    """
    checkpoint_dir(df.sparkSession)
    d = timer_s * US
    rows = _runs(df, key, order).where("rise or fall").select(key, "run", "seq", "_t", "rise", "fall").checkpoint()
    per_run = (rows.groupBy(key, "run")
               .agg(F.min(F.when(F.col("rise"), F.col("_t"))).alias("_a"),
                    F.max(F.when(F.col("rise"), F.col("_t"))).alias("_z"),
                    F.max(F.when(F.col("fall"), F.col("_t"))).alias("_tf"))
               .where(F.col("_a").isNotNull()))
    spans = F.col("_z") - F.col("_a") >= F.lit(d)
    once = per_run.where(~spans).select(key, "run", F.col("_a").alias("_t"), "_tf")
    long = per_run.where(spans).select(key, "run", "_tf")
    rises = _join_runs(rows.where("rise").select(key, "run", "seq", "_t"), long, key).checkpoint()
    arms = once
    if not rises.isEmpty():
        cands = _arm_candidates(rises, key, d).checkpoint()
        first = Window.partitionBy(key, "run").orderBy("_t", "seq")  # one row a run survives in each task
        starts = rises.withColumn("_n", F.row_number().over(first)).where("_n = 1")
        armed = _chain(cands, starts, key).withColumnRenamed("seq", "_seq")
        arms = arms.unionByName(_join_runs(rises, armed, key, [("seq", "_seq")]).select(key, "run", "_t", "_tf"))
    fires = F.col("_tf").isNull() | (F.col("_tf") >= F.col("_t") + F.lit(d))
    return arms.where(fires).select(
        key, ntz_from_micros(F.col("_t") + F.lit(d)).alias("alarm_ts"),
        F.lit(f"{ALARM_PREFIX}{timer_s}{ALARM_SUFFIX}").alias("message"))


def rising_first_alarm(df: DataFrame, timer_s: int, key: str = "id",
                       order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The first alarm of each run between strict falls, if it fires."""
    rows = _runs(df, key, order)
    d = timer_s * US
    per_run = (rows.groupBy(key, "run")
               .agg(F.min(F.when(F.col("rise"), F.col("_t"))).alias("_a"),
                    F.max(F.when(F.col("fall"), F.col("_t"))).alias("_tf")))
    fires = F.col("_a").isNotNull() & (F.col("_tf").isNull() | (F.col("_tf") >= F.col("_a") + F.lit(d)))
    return per_run.where(fires).select(key, ntz_from_micros(F.col("_a") + F.lit(d)).alias("alarm_ts"))
