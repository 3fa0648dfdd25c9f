"""Pipeline control (ST7), console sink (K4), batch writers, Kafka writers (K3/K5)."""

import pytest

from test_streaming import ONCE, logins, stream, write_files
from tripwire.operators import detect_alerts
from tripwire.schemas import Rules
from tripwire.sources import read_alert_updates, read_alerts, read_events
from tripwire.streaming import (
    await_pipeline,
    write_alert_updates,
    write_alerts,
    write_alerts_kafka,
    write_console,
    write_events,
    write_events_kafka,
)


def kafka_available(spark) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def test_await_pipeline_stops_everything(spark, scratch):
    src = write_files(f"{scratch}/in", [logins("u", "10:00")])
    q1 = write_events(stream(spark, src), f"{scratch}/ev", f"{scratch}/c1", trigger=ONCE)
    q2 = write_console(detect_alerts(stream(spark, src), Rules()), "console_test", trigger=ONCE)
    await_pipeline(spark, [q1, q2], timeout=120)
    assert not q1.isActive and not q2.isActive


def test_batch_frames_take_the_same_writers(spark, scratch):
    src = write_files(f"{scratch}/in", [logins("u", "10:00"), logins("u", "10:01")])
    batch = spark.read.schema(stream(spark, src).schema).json(src)
    assert write_events(batch, f"{scratch}/ev", by_date=True) is None
    back = read_events(spark, f"{scratch}/ev")
    assert back.count() == 10
    alerts = detect_alerts(batch, Rules())
    write_alerts(alerts, f"{scratch}/al")
    assert read_alerts(spark, f"{scratch}/al").count() == alerts.count()
    write_alert_updates(alerts, f"{scratch}/up")
    assert read_alert_updates(spark, f"{scratch}/up").select("batch_id").distinct().first().batch_id == 0


def test_update_log_replay_overwrites_its_batch(spark, scratch):
    src = write_files(f"{scratch}/in", [logins("u", "10:00")])
    alerts = detect_alerts(spark.read.schema(stream(spark, src).schema).json(src), Rules())
    write_alert_updates(alerts, f"{scratch}/up")
    write_alert_updates(alerts, f"{scratch}/up")  # a replayed batch 0
    assert read_alert_updates(spark, f"{scratch}/up").count() == alerts.count()


def test_kafka_writers_need_the_connector(spark, scratch):
    if kafka_available(spark):
        pytest.skip("connector present; broker I/O is not exercised by the unit tests")
    from test_parse import VALID
    from tripwire.operators import parse_events

    events = parse_events(spark.createDataFrame([(VALID,)], "value string"))
    with pytest.raises(Exception, match="(?i)kafka"):
        write_events_kafka(events, "localhost:9092", "events.raw")
    src = write_files(f"{scratch}/in", [logins("u", "10:00")])
    batch = spark.read.schema(stream(spark, src).schema).json(src)
    with pytest.raises(Exception, match="(?i)kafka"):
        write_alerts_kafka(detect_alerts(batch, Rules()), "localhost:9092")


def test_job_cli_once(spark, scratch):
    import json as _json

    from tripwire.streaming.job import main

    lines = [_json.dumps({"event_id": str(i), "timestamp": f"2025-11-03T10:00:{10 + i:02d}Z", "user_id": "u",
                          "session_id": "s", "ip_address": "i", "action": "login_failed"}) for i in range(5)]
    lines.append(_json.dumps({"event_id": "z", "timestamp": "2025-11-03T11:00:00Z", "user_id": "z",
                              "session_id": "s", "ip_address": "j", "action": "page_view"}))
    src = write_files(f"{scratch}/raw", [lines[:5], lines[5:]], as_text=True)
    assert main(["--source-dir", src, "--events-path", f"{scratch}/ev", "--alerts-path", f"{scratch}/al",
                 "--checkpoint-base", f"{scratch}/ck", "--once", "--event-files-per-folder", "2"]) == 0
    assert read_events(spark, f"{scratch}/ev").count() == 6
    assert read_alerts(spark, f"{scratch}/al").count() == 5


def test_null_action_round_trips_through_the_partition_folder(spark, scratch):
    import os

    from test_parse import VALID
    from tripwire.operators import parse_events

    no_action = VALID.replace('"action":"page_view",', "")
    events = parse_events(spark.createDataFrame([(VALID,), (no_action,)], "value string"))
    write_events(events, f"{scratch}/ev")
    assert "action=__HIVE_DEFAULT_PARTITION__" in os.listdir(f"{scratch}/ev")
    back = sorted((r.action is None, r.action) for r in read_events(spark, f"{scratch}/ev").collect())
    assert back == [(False, "page_view"), (True, None)]


def test_kafka_readers_need_the_connector(spark):
    from tripwire.sources import read_alerts_kafka, read_events_kafka

    if kafka_available(spark):
        pytest.skip("connector present; broker I/O is not exercised by the unit tests")
    for read in (read_events_kafka, read_alerts_kafka):
        for streaming in (True, False):
            with pytest.raises(Exception, match="(?i)kafka"):
                read(spark, "localhost:9092", starting_offsets="earliest", streaming=streaming)
        with pytest.raises(ValueError, match="startingOffsets"):
            read(spark, "localhost:9092", streaming=False)  # a batch read has no latest start


def test_read_events_by_date_leaves_the_shared_schema_alone(spark, scratch):
    from tripwire.schemas import PARSED_EVENT_SCHEMA

    n = len(PARSED_EVENT_SCHEMA.fields)
    src = write_files(f"{scratch}/in", [logins("u", "10:00")])
    batch = spark.read.schema(stream(spark, src).schema).json(src)
    from test_parse import VALID
    from tripwire.operators import parse_events

    write_events(parse_events(spark.createDataFrame([(VALID,)], "value string")), f"{scratch}/ev", by_date=True)
    back = read_events(spark, f"{scratch}/ev", by_date=True)
    assert back.columns[-1] == "event_date" and back.first().event_date.isoformat() == "2025-11-03"
    assert len(PARSED_EVENT_SCHEMA.fields) == n and batch is not None


def test_files_per_folder_bounds_the_file_count(spark, scratch):
    import glob

    from pyspark.sql import functions as F

    from test_parse import VALID
    from tripwire.operators import parse_events

    payloads = spark.range(0, 400, numPartitions=16).select(
        F.regexp_replace(F.lit(VALID), "9b1deb4d", F.col("id").cast("string")).alias("value"))
    many = parse_events(payloads)
    write_events(many, f"{scratch}/plain")
    write_events(many, f"{scratch}/bounded", files_per_folder=2)
    plain = glob.glob(f"{scratch}/plain/action=page_view/*.parquet")
    bounded = glob.glob(f"{scratch}/bounded/action=page_view/*.parquet")
    assert len(plain) == 16 and len(bounded) <= 2
    assert read_events(spark, f"{scratch}/bounded").count() == 400


def test_await_pipeline_reraises_and_stops_the_rest(spark, scratch):
    from pyspark.sql import functions as F

    src = write_files(f"{scratch}/in", [logins("u", "10:00")])
    failing = (stream(spark, src).select(F.raise_error(F.lit("boom")).alias("x")).writeStream
               .format("noop").option("checkpointLocation", f"{scratch}/c1").start())
    healthy = (stream(spark, src).writeStream.format("noop").option("checkpointLocation", f"{scratch}/c2")
               .trigger(processingTime="1 second").start())
    with pytest.raises(Exception, match="boom"):
        await_pipeline(spark, [failing, healthy], timeout=120)
    assert not failing.isActive and not healthy.isActive


def test_write_rejected_batch(spark, scratch):
    import os

    from test_parse import INVALID, VALID
    from tripwire.operators import split_events
    from tripwire.streaming import write_rejected

    raw = spark.createDataFrame([(VALID,), (INVALID,), ("garbage",)], "value string")
    _, rejected = split_events(raw, level="core")
    assert write_rejected(rejected, f"{scratch}/dead") is None
    folders = sorted(d for d in os.listdir(f"{scratch}/dead") if d.startswith("reject_reason="))
    assert folders == ["reject_reason=missing_fields", "reject_reason=not_json_object"]
    back = spark.read.parquet(f"{scratch}/dead")
    assert sorted(r.payload for r in back.collect()) == sorted([INVALID, "garbage"])


def test_job_cli_argument_errors():
    from tripwire.streaming.job import main

    with pytest.raises(SystemExit):
        main(["--events-path", "e", "--alerts-path", "a"])  # no source
    with pytest.raises(SystemExit):
        main(["--source-dir", "s", "--events-path", "e", "--alerts-path", "a", "--kafka-alerts"])
