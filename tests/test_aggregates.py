"""User aggregates, table aggregates and running folds: equal to the built-in forms, on hot and odd keys."""
import math
import re

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from fixture_rows import rows
from tidemark.functions import aggregates as ag
from tidemark.functions import udfs
from tidemark.operators import rolling
from tidemark.sources import readings as rd

SF = "/root/testdata/sf0.001"


class Joined(ag.Aggregate):
    """Order matters: the texts of the rows, one after the other."""

    ACC = "texts array<string>"
    OUT = "text string, n int"

    def create(self):
        return ([],)

    def accumulate(self, acc, text):
        return ([*acc[0], text],)

    def merge(self, a, b):
        return ([*a[0], *b[0]],)

    def emit(self, acc):
        return [("".join(x or "?" for x in acc[0]), len(acc[0]))]


class Each(ag.Aggregate):
    """A table aggregate with any number of rows, none for some groups; overrides the batch form."""

    ACC = "n bigint"
    OUT = "i bigint"

    def create(self):
        return (0,)

    def merge(self, a, b):
        return (a[0] + b[0],)

    def accumulate_many(self, acc, columns):
        return (acc[0] + (pc.sum(columns[0]).as_py() or 0),)

    def emit(self, acc):
        return [(i,) for i in range(acc[0])]


def test_aggregate_and_table_aggregate_equal_the_built_ins(spark):
    ev = rd.events_readings(spark, SF).repartition(5)
    got = dict(rows(ag.aggregate(ev, ["id"], ag.AvgTemp(), ["temp"])))
    assert got == pytest.approx(dict(rows(ev.groupBy("id").agg(udfs.avg_temp("temp")))))
    one = ev.withColumn("id", F.when(F.col("seq") % 7 == 0, F.lit(None)).otherwise(F.concat("id", (F.col("seq") % 90).cast("string"))))
    top = ag.aggregate(one, ["id"], ag.Top2Temp(), ["temp"])
    assert sorted(map(str, rows_any(top))) == sorted(map(str, rows_any(udfs.top2(one).select(*top.columns))))


def rows_any(df):
    return [tuple(r) for r in df.collect()]


def test_a_hot_key_ships_one_accumulator_a_task(spark, monkeypatch):
    """What is shuffled is at most one row for each key and task (or each time a task has held its limit of keys)."""
    df = spark.range(0, 60_000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
                                             F.col("id").cast("double").alias("v"))
    out = ag.aggregate(df, ["k"], ag.AvgTemp(), ["v"]).cache()
    assert out.count() == 51
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("MapInArrow", plan)) >= 2
    assert math.isclose(dict(rows(out))["hot"], sum(range(0, 60_000, 3)) / 20_000)
    monkeypatch.setattr(ag, "HELD_KEYS", 3)
    assert dict(rows(ag.aggregate(df, ["k"], ag.AvgTemp(), ["v"]))) == pytest.approx(dict(rows(out)))


def test_groups_of_odd_rows(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, None, 1), ("a", 1, None), ("b", 2, 0)], "k string, j int, v long")
    assert sorted(map(str, rows_any(ag.aggregate(df, ["k", "j"], Each(), ["v"])))) == ["(None, 1, 0)", "(None, 1, 1)", "(None, None, 0)"]
    assert rows_any(ag.aggregate(df, [], Each(), ["v"])) == [(0,), (1,), (2,)]
    assert ag.aggregate(df.where("false"), ["k"], Each(), ["v"]).columns == ["k", "i"]
    assert ag.aggregate(df.where("false"), ["k"], Each(), ["v"]).count() == 0
    with pytest.raises(TypeError):
        ag.aggregate(df.withColumn("v", F.col("v").cast("double")), ["v"], Each(), ["j"])


def test_running_reduce_equals_the_built_in(spark):
    ev = rd.with_arrival(rd.events_readings(spark, SF)).withColumn("temp", F.when(F.col("seq") == 40, F.lit(float("nan"))).otherwise(F.col("temp")))
    fold = ag.Reduce(ag.reduce_reading, "id string, timestamp bigint, temp double")
    got = ag.running(ev, ["id"], ["arrival", "seq"], fold, ["id", "timestamp", "temp"], keep=["arrival", "seq"], n=9)
    want = rolling.rolling_reduce(ev, order=["arrival", "seq"])
    assert sorted(map(str, rows_any(got.select(*want.columns)))) == sorted(map(str, rows_any(want)))


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_keeps_the_order_of_a_fold_that_does_not_commute(spark, keys):
    """Null keys, one key over all buckets, keys that start late: every prefix in order, whatever the buckets."""
    data = [(i, None if i % 5 == 0 else "late" if i > 80 and i % 2 else "k", "abcdefghij"[i % 10] if i % 11 else None) for i in range(100)]
    df = spark.createDataFrame(data, "seq long, k string, x string").repartition(7)
    want, so_far = {}, {}
    for i, k, x in data:
        k = k if keys else ""
        so_far[k] = so_far.get(k, "") + (x or "?")
        want[i] = (so_far[k], len(so_far[k]))
    for n in (1, 4, 30):
        got = {r.seq: (r.text, r.n) for r in ag.running(df, keys, ["seq"], Joined(), ["x"], keep=["seq"], n=n).collect()}
        assert got == want
    assert ag.running(df.where("false"), keys, ["seq"], Joined(), ["x"]).count() == 0
