import json

from pyspark.sql import functions as F

from tripwire.sources.tables import (
    EVENTS_TABLE_SCHEMA,
    event_records,
    read_event_records,
    spread,
)

SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, EVENTS_TABLE_SCHEMA)


def test_payload_shape(spark):
    from datetime import datetime

    rows = [(5, datetime(2024, 1, 2, 3, 4, 5, 600000), 13, "purchase", 12.5, '{"k": 7}'),
            (97, datetime(2024, 1, 2, 3, 4, 5), 13, "view", 1.0, '{"k": 7}'),
            (89, datetime(2024, 1, 2, 3, 4, 5), 13, "error", 1.0, '{"k": 7}')]
    out = event_records(table(spark, rows)).collect()
    first = json.loads(bytes(out[0].value))
    assert out[0].key == "usr_13"
    assert first == {"event_id": "5", "timestamp": "2024-01-02T03:04:05.600000+00:00", "user_id": "usr_13",
                     "session_id": "sess_13", "ip_address": "10.0.5.3", "device_type": "laptop",
                     "location_country": "PT", "location_city": "Porto", "action": "transaction_success",
                     "url_path": "/purchase", "amount": 12.5, "user_agent": "agent/1"}
    assert bytes(out[1].value) == b"not json"  # id divisible by 97
    assert json.loads(bytes(out[2].value))["timestamp"] == "bad-ts"  # id divisible by 89


def test_whole_table_is_read(spark):
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert read_event_records(spark, SF).count() == n


def test_fan_out_is_the_callers_choice(spark):
    scan = spark.read.schema(EVENTS_TABLE_SCHEMA).parquet(f"{SF}/events.parquet")
    assert spread(scan, 5).rdd.getNumPartitions() == 5
    assert spread(scan, 0) is scan
    assert read_event_records(spark, SF, parts=3).rdd.getNumPartitions() == 3
