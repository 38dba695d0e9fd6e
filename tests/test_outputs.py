"""Several outputs of one scan, and elements of mixed type."""
import datetime as dt
import re
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from fixture_rows import rows
from tidemark.operators import outputs
from tidemark.sources import readings as rd
from tidemark.streaming import runner


def test_outputs_are_written_in_one_scan(spark, sensor):
    tag = F.col("temp") > 60
    out = outputs.split_once(sensor, {"high": tag, "low": ~tag, "none": F.lit(None).cast("boolean"), "first": F.col("id") == "sensor1"})
    assert {k: v.count() for k, v in out.items()} == {"high": 4, "low": 4, "none": 0, "first": 3}
    assert rows(out["high"]) == rows(sensor.where(tag)) and out["none"].schema == sensor.schema
    plan = out["high"]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == 1 and "PartitionFilters: [isnotnull(_tag" in plan  # only its own folder
    assert outputs.split_once(sensor, {}) == {}


def test_outputs_of_a_stream(spark, sensor):
    base = tempfile.mkdtemp(prefix="tidemark-outs-")
    sensor.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(sensor.schema).parquet(f"{base}/in")
    tag = F.col("temp") > 60

    def to(name):
        return lambda df, batch: df.write.mode("overwrite").parquet(f"{base}/{name}/{batch}")
    runner.run(stream, "outs", f"{base}/ck", foreach_batch=outputs.foreach_batch_outputs({"high": tag, "low": ~tag}, {"high": to("high"), "low": to("low")}, f"{base}/split"))
    assert rows(spark.read.parquet(f"{base}/high/0")) == rows(sensor.where(tag))
    assert rows(spark.read.parquet(f"{base}/low/0")) == rows(sensor.where(~tag))


def test_mixed_elements_keep_their_types(spark):
    values = [0, 1.4, 323, "dsds", True, None, Decimal("2.50"), dt.date(2020, 1, 2), {"a": [1]}, "7"]
    df = rd.from_elements(spark, values)
    assert df.schema["value"].dataType.simpleString() == "variant"
    got = df.select("seq", *[rd.typed("value", k).alias(k) for k in ("bigint", "double", "string", "boolean", "date")]).orderBy("seq").collect()
    assert [r.bigint for r in got] == [0, None, 323] + [None] * 7
    assert [r.double for r in got] == [None, 1.4, None, None, None, None, 2.5, None, None, None]
    assert [r.string for r in got] == [None, None, None, "dsds"] + [None] * 5 + ["7"]
    assert [r.boolean for r in got].index(True) == 4 and got[7].date == dt.date(2020, 1, 2)
    assert rd.from_elements(spark, []).count() == 0
