import json
from datetime import datetime

from tripwire.operators import decode_alerts, encode_alerts, encode_events, parse_events, rejected_messages
from tripwire.schemas import ALERT_COLUMNS, ALERT_SCHEMA
from tripwire.sources import kafka_source_options
from tripwire.streaming import kafka_sink_options

T = datetime(2025, 11, 3, 10, 0)


def test_alert_message_format_and_roundtrip(spark):
    rows = [(T, T, "u1", "1.1.1.1", "X", "HIGH", 5, 0.0, None, T),
            (T, T, None, "2.2.2.2", "Y", "LOW", 1, 12.5, "d", T)]
    df = spark.createDataFrame(rows, ALERT_SCHEMA)
    msgs = encode_alerts(df).collect()
    assert msgs[0].key == "u1" and msgs[1].key is None
    body = json.loads(msgs[0].value)
    assert body["window_start"] == "2025-11-03T10:00:00.000Z"
    assert "details" not in body  # NULL fields are dropped
    assert list(body) == [c for c in ALERT_COLUMNS if c != "details"]
    back = decode_alerts(encode_alerts(df))
    assert back.columns == list(ALERT_COLUMNS)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_event_roundtrip(spark):
    payload = ('{"event_id":"e1","timestamp":"2025-11-03T10:00:00+00:00","user_id":"u","session_id":"s",'
               '"ip_address":"i","action":"login_failed","amount":2.5}')
    events = parse_events(spark.createDataFrame([(payload,)], "value string"))
    msgs = encode_events(events)
    assert msgs.first().key == "u"
    again = parse_events(msgs)
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in events.collect()]


def test_kafka_options():
    assert kafka_source_options("b:9092", "events.raw") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "events.raw",
        "startingOffsets": "latest", "failOnDataLoss": "false"}
    assert kafka_sink_options("b:9092", "events.anomalies") == {
        "kafka.bootstrap.servers": "b:9092", "topic": "events.anomalies"}


def test_kafka_min_partitions_and_batch_offsets(spark):
    opts = kafka_source_options("b:9092", "t", min_partitions=64, max_offsets_per_trigger=5_000_000)
    assert opts["minPartitions"] == "64" and opts["maxOffsetsPerTrigger"] == "5000000"


def test_decode_garbage_alert_message(spark):
    messages = spark.createDataFrame([("garbage",), (None,), ("{}",)], "value string")
    assert decode_alerts(messages).count() == 0
    assert rejected_messages(messages).count() == 3
