"""The bucketed ordered scans equal a plain per-key window.

Bucket counts are forced (``n``) so that keys are cut into many buckets,
some smaller than the look-back; the global (no key) form, NULL keys, NULL
order values and hot keys are covered.
"""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixture_rows import rows
from tidemark.operators import alerts, ordered, rolling, windows
from tidemark.sources.readings import events_readings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ev(spark):
    return events_readings(spark, SF).cache()


@pytest.mark.parametrize("n", [None, 3, 64])
def test_running_matches_window(ev, n):
    aggs = {"c": ("count", None), "mx": ("max", "temp"), "mn": ("min", "temp"),
            "s": ("sum", F.col("temp").cast("decimal(38,10)")), "l": ("last", "temp")}
    got = ordered.running(ev, ["id"], ["ts", "seq"], aggs, inclusive=False, n=n)
    w = Window.partitionBy("id").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    exp = ev.select("seq", F.count(F.lit(1)).over(w).alias("c"), F.max("temp").over(w).alias("mx"),
                    F.min("temp").over(w).alias("mn"),
                    F.sum(F.col("temp").cast("decimal(38,10)")).over(w).alias("s"),
                    F.lag("temp").over(Window.partitionBy("id").orderBy("ts", "seq")).alias("l"))
    assert rows(got, "seq", "c", "mx", "mn", "s", "l") == rows(exp, "seq", "c", "mx", "mn", "s", "l")


@pytest.mark.parametrize("n", [2, 40])
def test_global_running_max(ev, n):
    got = ordered.running(ev, [], ["ts", "seq"], {"m": ("max", "temp")}, n=n)
    exp = ev.select("seq", F.max("temp").over(Window.orderBy("ts", "seq")
                                              .rowsBetween(Window.unboundedPreceding, 0)).alias("m"))
    assert rows(got, "seq", "m") == rows(exp, "seq", "m")


@pytest.mark.parametrize("n,k", [(5, 1), (64, 3), (200, 9)])
def test_lookback_matches_window(ev, n, k):
    cols = {"cnt": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-k, 0)),
            "mn": lambda w: F.min("temp").over(w.rowsBetween(-k, 0)),
            "p": lambda w: F.lag("temp", k).over(w)}
    got = ordered.with_lookback(ev, ["id"], ["ts", "seq"], k, cols, n=n)
    w = Window.partitionBy("id").orderBy("ts", "seq")
    exp = ev.select("seq", F.count(F.lit(1)).over(w.rowsBetween(-k, 0)).alias("cnt"),
                    F.min("temp").over(w.rowsBetween(-k, 0)).alias("mn"), F.lag("temp", k).over(w).alias("p"))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select("seq", "cnt", "mn", "p").collect()), key=key) == \
        sorted(map(tuple, exp.collect()), key=key)


def test_null_keys_and_null_order_keep_their_context(spark):
    data = [(None, i, float(i * 37 % 11)) for i in range(40)] + [("a", i, float(i * 17 % 7)) for i in range(40)]
    df = spark.createDataFrame(data, "id string, seq long, temp double")
    got = ordered.previous(df, ["id"], ["seq"], ["temp"], k=2, n=9)
    w = Window.partitionBy("id").orderBy("seq")
    exp = df.select("id", "seq", "temp", F.lag("temp", 1).over(w).alias("prev1_temp"), F.lag("temp", 2).over(w).alias("prev2_temp"))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, exp.collect()), key=key)
    late = spark.createDataFrame([("a", None, 1.0), ("a", 5, 2.0), ("a", 6, 3.0)], "id string, seq long, temp double")
    got = ordered.running(late, ["id"], ["seq"], {"c": ("count", None)}, n=4)
    assert sorted((r.temp, r.c) for r in got.collect()) == [(1.0, 1), (2.0, 2), (3.0, 3)]


def test_null_key_jumps_and_frames(spark):
    data = [(None, i, float((i % 3) * 20), 100 + i) for i in range(40)]
    df = spark.createDataFrame(data, "id string, seq long, temp double, timestamp long")
    jumps = [(a, b) for a, b in zip([r[2] for r in data], [r[2] for r in data][1:]) if abs(a - b) > 10]
    assert len(alerts.temp_jump(df, 10.0).collect()) == len(jumps)
    assert sorted(r.cnt for r in windows.count_window(df, 3).collect())[:3] == [1, 2, 3]


def test_hot_key_is_cut_into_balanced_buckets(spark):
    """A key holding a third of all rows is spread over many buckets of about equal size."""
    ev = events_readings(spark, "/root/testdata/sf0.01")
    skewed = ev.withColumn("id", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("id"))).select("id", "ts", "seq")
    n = 16
    by = ordered.buckets(skewed, ["ts"], n)
    b = skewed.withColumn("b", by.column)
    sizes = [r["count"] for r in b.groupBy("b").count().collect()]
    assert len(sizes) == n and max(sizes) <= 2.0 * sum(sizes) / n
    hot = [r["count"] for r in b.where("id = 'hot'").groupBy("b").count().collect()]
    assert len(hot) == n and max(hot) <= 0.2 * sum(hot)
    got = ordered.running(skewed, ["id"], ["ts", "seq"], {"c": ("count", None)}, n=n)
    exp = skewed.select("seq", F.row_number().over(Window.partitionBy("id").orderBy("ts", "seq")).cast("bigint").alias("c"))
    assert rows(got, "seq", "c") == rows(exp, "seq", "c")


def test_uneven_order_still_gives_even_buckets(spark):
    """Nine tenths of the rows in a hundredth of the range: buckets follow the counts, not the range."""
    df = spark.range(10_000).select((F.when(F.col("id") % 10 == 0, F.col("id") * 100).otherwise(F.col("id"))).alias("seq"))
    by = ordered.buckets(df, ["seq"], 10)
    sizes = [r["count"] for r in df.groupBy(by.column.alias("b")).count().collect()]
    assert max(sizes) <= 2.5 * 1000


def test_no_plan_gathers_base_rows_in_one_task(ev):
    """Only per-bucket tables may meet in a single partition, and nothing is limited or sampled."""
    for df in (rolling.rolling_count(ev), ordered.running(ev, [], ["ts", "seq"], {"m": ("max", "temp")}),
               windows.over_rows(ev), alerts.temp_jump(ev)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in plan.replace("WindowGroupLimit", "") and "Sample" not in plan
        for at in [i for i in range(len(plan)) if plan.startswith("Exchange SinglePartition", i)]:
            below = plan[at:].split("\n")[1]
            assert "Aggregate" in below or "Project" in below  # the per-bucket summary


def test_bucket_count_follows_data_size(spark, ev):
    total = ev.count()
    spark.conf.set(ordered.ROWS_PER_BUCKET_CONF, "50")
    try:
        assert ordered.buckets(ev, ["ts"]).count == max(4, -(-total // 50))
    finally:
        spark.conf.unset(ordered.ROWS_PER_BUCKET_CONF)
    assert ordered.buckets(ev, ["ts"]).count == 4


def test_text_order_is_refused(ev):
    with pytest.raises(TypeError):
        ordered.buckets(ev, ["id"])


def test_top2_retract_follows_arrival(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 3.0), ("a", 3, 4.0), ("a", 4, 1.0), ("a", 5, 5.0), ("a", 6, float("nan"))],
                               "id string, seq long, temp double")
    low = -1.7976931348623157e308
    got = sorted((r.seq, r.change, r["rank"], r.temp) for r in rolling.top2_retract(df).collect())
    assert got == [(1, 1, 1, 5.0), (1, 1, 2, low), (2, 0, 1, 5.0), (2, 0, 2, low), (2, 1, 1, 5.0), (2, 1, 2, 3.0),
                   (3, 0, 1, 5.0), (3, 0, 2, 3.0), (3, 1, 1, 5.0), (3, 1, 2, 4.0),
                   (5, 0, 1, 5.0), (5, 0, 2, 4.0), (5, 1, 1, 5.0), (5, 1, 2, 5.0)]


def _sizes(df, order, n):
    """Rows per bucket; buckets must follow the order."""
    by = ordered.buckets(df, order, n)
    held = [r._bk for r in df.select(by.column.alias("_bk"), *order).orderBy(*order).select("_bk").collect()]
    assert held == sorted(held)
    return [held.count(b) for b in range(by.count)]


def test_buckets_are_even_whatever_the_order_values(spark):
    """One row in the year 9999, one time in two thirds of the rows, one time in all rows, magnitudes of any size."""
    ts = lambda text: F.expr(f"TIMESTAMP_NTZ'{text} 00:00:00'")
    base = spark.range(20_000).select(F.timestamp_add("SECOND", (F.col("id") * 13 % 2_592_000).cast("int"), ts("2024-01-01")).alias("ts"), F.col("id").alias("seq"))
    far = spark.range(1).select(ts("9999-12-31").alias("ts"), F.lit(10**9).alias("seq"))
    tied = base.withColumn("ts", F.when(F.col("seq") % 3 > 0, ts("2024-01-05")).otherwise(F.col("ts")))
    for df in (base, base.union(far), tied.union(far), base.withColumn("ts", ts("2024-01-05"))):
        sizes = _sizes(df, ["ts", "seq"], 16)
        assert max(sizes) <= 2 * sum(sizes) / 16
    wide = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, F.lit(float("nan"))).when(F.col("id") % 101 == 0, F.lit(float("-inf")))
                                      .otherwise(F.exp(F.rand(3) * 300)).alias("x"), F.col("id").alias("s")).cache()
    assert max(_sizes(wide, ["x", "s"], 16)) <= 2 * 20_000 / 16
    assert len(set(_sizes(base, ["seq"], 9_000))) <= 6  # more buckets than the least number of cells


def test_large_longs_that_are_equal_as_doubles_keep_their_order(spark):
    big = 2**60
    df = spark.createDataFrame([(big + i // 50, 50 - i % 50) for i in range(2_000)], "a long, b long")
    assert max(_sizes(df, ["a", "b"], 8)) <= 2_000


def test_an_order_value_outside_the_range_does_not_overflow(spark):
    df = spark.range(1_000).select(F.lit("k").alias("k"), F.col("id").alias("seq"))
    by = ordered.buckets(df, ["seq"], 4)
    out = spark.createDataFrame([(-10**18,), (10**18,)], "seq long").select(by.column.alias("b")).collect()
    assert [r.b for r in out] == [0, 3]
