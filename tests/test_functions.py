import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripwire.functions import as_ntz, is_json_object, missing_fields, nan_to_null, watermark_safe


@pytest.mark.parametrize("text,expected", [
    ('{"a":1}', True), ("{}", True), ("[]", False), ("3", False), ('"x"', False),
    ("garbage", False), ("", False), (None, False), ("{broken", False),
])
def test_is_json_object(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(is_json_object("t").alias("o")).first().o is expected


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    assert [r.y for r in df.select(nan_to_null("x").alias("y")).collect()] == [1.5, None, None]
    assert math.isnan(df.agg(F.sum("x")).first()[0])  # why the guard exists
    assert df.agg(F.sum(nan_to_null("x"))).first()[0] == 1.5


def test_missing_fields_keeps_field_order(spark):
    df = spark.createDataFrame([("a", None, None), ("a", "b", "c")], "x string, y string, z string")
    assert [r.m for r in df.select(missing_fields(["x", "y", "z"]).alias("m")).collect()] == [["y", "z"], []]


def test_as_ntz_is_the_utc_wall_clock(spark):
    df = spark.createDataFrame([("2025-11-03T12:00:00+02:00",)], "t string")
    out = df.select(as_ntz(F.try_to_timestamp("t")).alias("n"))
    assert dict(out.dtypes)["n"] == "timestamp_ntz" and out.first().n == datetime(2025, 11, 3, 10, 0)


def test_watermark_safe_is_plain_on_batch(spark, tmp_path):
    batch = spark.createDataFrame([("x",)], "action string")
    cond = F.col("action") == "x"
    assert str(watermark_safe(batch, cond)) == str(cond)
    (tmp_path / "s").mkdir()
    stream = spark.readStream.schema("action string, event_time timestamp").json(str(tmp_path / "s"))
    assert "CASE WHEN" in str(watermark_safe(stream, cond))
