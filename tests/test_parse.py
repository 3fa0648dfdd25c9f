import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tripwire.operators import classify_events, decode_events, parse_events, split_events, validate_events
from tripwire.functions import event_time
from tripwire.sources import read_split
from tripwire.streaming import write_split


def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_permissive_field_parsing(spark):
    raw = payloads(
        spark,
        '{"event_id":"a","amount":1.5,"action":"x"}',
        '{"event_id":"b"}',
        "garbage",
        "[]",
        None,
        '{"event_id":"c","amount":"oops","action":"x"}',
        '{"event_id":"d","amount":"12.5","action":"x"}',
        '{"event_id":7,"amount":3,"action":"x","extra":1}',
        '{"event_id":"e","amount":NaN,"action":"x"}',
    )
    rows = [tuple(r) for r in decode_events(raw).select("event_id", "amount", "action").collect()]
    assert rows[0] == ("a", 1.5, "x")
    assert rows[1] == ("b", None, None)
    assert rows[2] == rows[3] == rows[4] == (None, None, None)
    assert rows[5] == ("c", None, "x")
    assert rows[6] == ("d", None, "x")  # a quoted number is not a double
    assert rows[7] == ("7", 3.0, "x")  # a number in a string field keeps its text
    assert rows[8][0] == "e" and math.isnan(rows[8][1])


@pytest.mark.parametrize("text,expected", [
    ("nope", None),
    ("", None),
    (None, None),
    ("2025-11-03T10:00:00+00:00", datetime(2025, 11, 3, 10, 0)),
    ("2025-11-03T10:00:00Z", datetime(2025, 11, 3, 10, 0)),
    ("2025-11-03T12:00:00+02:00", datetime(2025, 11, 3, 10, 0)),
    ("2025-11-03T10:00:00.123456", datetime(2025, 11, 3, 10, 0, 0, 123456)),
])
def test_event_time_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], StructType([StructField("t", StringType())]))
    assert df.select(event_time("t").alias("et")).first().et == expected


def test_parse_drops_rows_without_event_time(spark):
    raw = payloads(
        spark,
        '{"event_id":"a","timestamp":"2025-11-03T10:00:00Z","action":"login_failed"}',
        '{"event_id":"b","timestamp":"bad"}',
        "not json",
    ).withColumn("value", F.col("value").cast("binary"))
    out = parse_events(raw).collect()
    assert [r.event_id for r in out] == ["a"]
    assert out[0].event_time == datetime(2025, 11, 3, 10, 0)
    assert len(parse_events(raw).columns) == 13


def test_parse_parses_each_payload_once(spark):
    """Filters on parsed fields must not be pushed below the parse (one from_json)."""
    raw = payloads(spark, '{"event_id":"a","timestamp":"2025-11-03T10:00:00Z","action":"x"}')
    df = parse_events(raw).filter(F.col("action") == "x")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


VALID = ('{"event_id":"ev-0001","timestamp":"2025-11-03T10:00:00+00:00",'
         '"user_id":"ada","session_id":"s-17","ip_address":"172.16.4.9",'
         '"device_type":"kiosk","location_country":"KE","location_city":"Nairobi",'
         '"action":"page_view","url_path":"/shelf/7","amount":0.0,"user_agent":"agent/1"}')
INVALID = ('{"event_id":"x1","timestamp":"2025-11-03T10:00:00+00:00","session_id":"s",'
           '"ip_address":"10.0.0.1"}')


def test_validation_levels(spark):
    events = decode_events(payloads(spark, VALID, INVALID))
    strict = [r.errors for r in validate_events(events, "strict").collect()]
    core = [r.errors for r in validate_events(events, "core").collect()]
    assert strict[0] == [] and core[0] == []
    assert strict[1] == ["user_id", "device_type", "location_country", "location_city", "action",
                         "url_path", "user_agent"]
    assert core[1] == ["user_id", "action"]


def test_default_amount(spark):
    events = decode_events(payloads(spark, INVALID))
    assert validate_events(events, "core", default_amount=True).first().amount == 0.0


def test_split_events_reasons(spark):
    raw = payloads(spark, VALID, INVALID, '{"event_id":"b","timestamp":"bad"}', "garbage", "[]", "3", None)
    valid, rejected = split_events(raw, level="core")
    assert [r.event_id for r in valid.collect()] == ["ev-0001"]
    reasons = [r.reject_reason for r in rejected.collect()]
    assert reasons == ["missing_fields", "bad_timestamp", "not_json_object", "not_json_object",
                       "not_json_object", "not_json_object"]
    # Without a level, field presence is not checked.
    valid2, _ = split_events(raw)
    assert valid2.count() == 2


def test_repeated_keys_are_an_object(spark):
    out = classify_events(payloads(spark, '{"a":1,"a":2,"timestamp":"bad"}')).first()
    assert out.reject_reason == "bad_timestamp"


def test_classify_keeps_payload(spark):
    out = classify_events(payloads(spark, "garbage")).first()
    assert out.payload == "garbage" and out.reject_reason == "not_json_object"


def test_watermark_is_set_on_streams_only_when_asked(spark):
    raw = payloads(spark, VALID)
    plan = parse_events(raw, "10 minutes")._jdf.queryExecution().logical().toString()
    assert "EventTimeWatermark" in plan
    assert "EventTimeWatermark" not in parse_events(raw)._jdf.queryExecution().logical().toString()


def test_amount_type(spark):
    assert dict(parse_events(payloads(spark, VALID)).dtypes)["amount"] == DoubleType().simpleString()


def test_both_sides_in_one_write(spark, tmp_path):
    raw = payloads(spark, VALID, INVALID, "garbage", '{"event_id":"b","timestamp":"bad"}', None)
    write_split(raw, str(tmp_path / "split"), level="core")
    valid, rejected = read_split(spark, str(tmp_path / "split"))
    want_valid, want_rejected = split_events(raw, level="core")
    assert valid.collect() == want_valid.collect() and valid.columns == want_valid.columns
    assert sorted(map(str, rejected.select(*want_rejected.columns).collect())) == sorted(map(str, want_rejected.collect()))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan  # no second parse
    assert "PartitionFilters: [isnotnull(outcome" in plan
    assert valid.inputFiles() and all("outcome=" in f for f in valid.inputFiles())


def test_both_sides_of_a_stream_in_one_query(spark, tmp_path):
    source = str(tmp_path / "in")
    payloads(spark, VALID, "garbage", INVALID).select(F.col("value").cast("string").alias("value")).write.text(source)
    query = write_split(spark.readStream.text(source), str(tmp_path / "out"), "strict", str(tmp_path / "ck"), {"availableNow": True})
    query.awaitTermination(120)
    assert query.exception() is None
    valid, rejected = read_split(spark, str(tmp_path / "out"))
    assert valid.count() == 1 and {r.reject_reason for r in rejected.collect()} == {"not_json_object", "missing_fields"}
    assert len(query.lastProgress["sources"]) == 1
