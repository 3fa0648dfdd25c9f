"""Structured Streaming behaviour: watermark, late rows, output modes, restart.

Input files are read one per micro-batch (``maxFilesPerTrigger=1``) in
modification-time order; the times are set explicitly instead of sleeping.
"""

import json
import os
import time

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from tripwire.operators import detect_alerts, latest_alerts, parse_events
from tripwire.schemas import Rules
from tripwire.sources import read_alerts, read_events
from tripwire.streaming import PipelineSpec, run_once, start_pipeline, stop_all, write_alerts, write_events

SCHEMA = StructType([
    StructField("user_id", StringType()),
    StructField("ip_address", StringType()),
    StructField("action", StringType()),
    StructField("amount", DoubleType()),
    StructField("event_time", TimestampType()),
])
ONCE = {"availableNow": True}


def write_files(folder, batches, as_text=False):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 3600
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"batch-{i:03d}.json")
        with open(path, "w") as f:
            for r in rows:
                f.write((r if as_text else json.dumps(r)) + "\n")
        os.utime(path, (base + 10 * i, base + 10 * i))
    return folder


def logins(user, minute, n=5, ip="i"):
    return [{"user_id": user, "ip_address": ip, "action": "login_failed", "amount": 0.0,
             "event_time": f"2025-11-03T{minute}:{s:02d}Z"} for s in range(10, 10 + 10 * n, 10)]


def stream(spark, folder):
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").json(folder)
            .withWatermark("event_time", "10 minutes"))


LATE_BATCHES = [logins("u", "10:00"), logins("w", "11:00"), logins("late1", "10:00"),
                logins("late2", "10:00"), logins("x", "12:00"), logins("late3", "10:56")]


def counts(rows):
    out = {}
    for r in rows:
        out[r.user_id] = out.get(r.user_id, 0) + 1
    return out


def collect_updates(spark, df, out):
    return (df.writeStream.outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", out + "_ckpt")
            .foreachBatch(lambda b, _id: b.write.mode("append").parquet(out)).start())


def test_late_rows_append_update_batch(spark, scratch):
    src = write_files(f"{scratch}/in", LATE_BATCHES)
    rules = Rules()
    # append: closed windows only, late2 dropped, x still open
    q = run_once(write_alerts(detect_alerts(stream(spark, src), rules), f"{scratch}/append",
                              f"{scratch}/append_ckpt", trigger=ONCE))
    assert counts(read_alerts(spark, f"{scratch}/append").collect()) == {"u": 5, "w": 5, "late1": 5, "late3": 5}
    assert q.lastProgress is not None
    # update: the same plus x
    run_once(collect_updates(spark, detect_alerts(stream(spark, src), rules), f"{scratch}/update"))
    assert counts(spark.read.parquet(f"{scratch}/update").collect()) == {
        "u": 5, "w": 5, "late1": 5, "late3": 5, "x": 5}
    # batch: no late dropping
    batch = detect_alerts(spark.read.schema(SCHEMA).json(src), rules)
    assert counts(batch.collect()) == {u: 5 for u in ("u", "w", "late1", "late2", "x", "late3")}


def test_event_sink_keeps_late_rows_and_restarts_exactly_once(spark, scratch):
    src = write_files(f"{scratch}/in", LATE_BATCHES)
    out, ckpt = f"{scratch}/events", f"{scratch}/events_ckpt"
    run_once(write_events(stream(spark, src), out, ckpt, trigger=ONCE))
    assert spark.read.parquet(out).count() == 30
    run_once(write_events(stream(spark, src), out, ckpt, trigger=ONCE))  # restart from the checkpoint
    assert spark.read.parquet(out).count() == 30
    assert sorted(os.listdir(out))[0] == "_spark_metadata"
    assert any(d.startswith("action=login_failed") for d in os.listdir(out))


WATERMARK_BATCHES = [
    logins("u", "10:00"),
    [{"user_id": "u", "ip_address": "i", "action": "page_view", "amount": 0.0, "event_time": "2025-11-03T10:00:55Z"}],
    [{"user_id": "z", "ip_address": "j", "action": "add_to_cart", "amount": 0.0, "event_time": "2025-11-03T11:00:00Z"}],
]
WM_RULES = Rules(max_failed_logins=5, max_clicks_per_window=1)


def test_every_event_advances_the_watermark(spark, scratch):
    """An add_to_cart event no rule reads still closes the windows (guarded filter)."""
    src = write_files(f"{scratch}/in", WATERMARK_BATCHES)
    q = run_once(write_alerts(detect_alerts(stream(spark, src), WM_RULES), f"{scratch}/append",
                              f"{scratch}/ckpt", trigger=ONCE))
    out = read_alerts(spark, f"{scratch}/append").collect()
    kinds = {}
    for r in out:
        kinds[r.anomaly_type] = kinds.get(r.anomaly_type, 0) + 1
    assert kinds == {"CREDENTIAL_STUFFING_BRUTE_FORCE": 5, "BOT_SCRAPING_BURST": 5}
    assert q.lastProgress["eventTime"]["watermark"] == "2025-11-03T10:50:00.000Z"


def test_update_mode_reduced_by_latest_equals_batch(spark, scratch):
    src = write_files(f"{scratch}/in", WATERMARK_BATCHES)
    run_once(collect_updates(spark, detect_alerts(stream(spark, src), WM_RULES), f"{scratch}/update"))
    updates = spark.read.parquet(f"{scratch}/update")
    assert updates.count() == 15  # the fused form re-emits every matched rule of a changed group
    key = ("window_start", "window_end", "user_id", "ip_address", "anomaly_type", "event_count")
    latest = sorted(tuple(r[k] for k in key) for r in latest_alerts(updates).collect())
    batch = detect_alerts(spark.read.schema(SCHEMA).json(src), WM_RULES)
    assert latest == sorted(tuple(r[k] for k in key) for r in batch.collect())
    assert len(latest) == 10


def test_pipeline_from_raw_payloads(spark, scratch):
    """start_pipeline: raw JSON text -> parse -> watermark -> events + alerts sinks."""
    lines = []
    for minute in ("10:00", "10:20"):
        for s in range(10, 60, 10):
            lines.append(json.dumps({"event_id": f"{minute}-{s}", "timestamp": f"2025-11-03T{minute}:{s:02d}Z",
                                     "user_id": "u", "session_id": "s", "ip_address": "i",
                                     "action": "login_failed"}))
    lines += ["not json", '{"event_id":"b","timestamp":"bad"}']
    src = write_files(f"{scratch}/raw", [lines[:7], lines[7:]], as_text=True)
    raw = spark.readStream.option("maxFilesPerTrigger", "1").text(src)
    spec = PipelineSpec(events_path=f"{scratch}/events", alerts_path=f"{scratch}/alerts",
                        checkpoint_base=f"{scratch}/ckpt", rules=Rules(), trigger=ONCE, rocksdb_state=True,
                        rejected_path=f"{scratch}/rejected")
    queries = start_pipeline(spark, raw, spec)
    try:
        assert [q.name for q in queries] == ["events_parquet", "alerts_parquet", "rejected_parquet"]
        for q in queries:
            run_once(q)
    finally:
        stop_all(queries)
    assert read_events(spark, f"{scratch}/events").count() == 10
    alerts = read_alerts(spark, f"{scratch}/alerts").collect()
    # 10:00 burst windows are closed by the 10:20 events; the 10:20 ones are still open.
    assert len(alerts) == 5 and {r.event_count for r in alerts} == {5}
    rejected = spark.read.parquet(f"{scratch}/rejected").collect()
    assert sorted(r.reject_reason for r in rejected) == ["bad_timestamp", "not_json_object"]
    assert {r.payload for r in rejected} == {"not json", '{"event_id":"b","timestamp":"bad"}'}
    metrics = queries[1].lastProgress["stateOperators"][0]["customMetrics"]
    assert any(k.startswith("rocksdb") for k in metrics)  # the alert query keeps its state in RocksDB
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_parse_events_stream_has_watermark(spark, scratch):
    src = write_files(f"{scratch}/raw", [["{}"]], as_text=True)
    df = parse_events(spark.readStream.text(src), "10 minutes")
    assert df.isStreaming
    with pytest.raises(Exception):
        write_events(df, f"{scratch}/x")  # a streaming sink needs a checkpoint


def test_streaming_first_alerts_shares_the_watermark(spark, scratch):
    from tripwire.operators import first_alerts
    from tripwire.operators.alerts import REFERENCE_FIRST_KEYS

    two_ips = logins("u", "10:00", ip="1.1.1.1") + logins("u", "10:00", ip="2.2.2.2")
    src = write_files(f"{scratch}/in", [two_ips, logins("v", "11:00")])
    live = detect_alerts(stream(spark, src), Rules(), keep_window=True)
    deduped = first_alerts(live, REFERENCE_FIRST_KEYS)
    assert "window" not in deduped.columns
    run_once(write_alerts(deduped, f"{scratch}/out", f"{scratch}/ckpt", trigger=ONCE))
    out = read_alerts(spark, f"{scratch}/out").collect()
    assert len(out) == 5 and {r.user_id for r in out} == {"u"}  # one IP kept per (user, type, window end)
    with pytest.raises(ValueError):
        first_alerts(detect_alerts(stream(spark, src), Rules()))


def test_watermark_report_counts_late_rows(spark, scratch):
    from tripwire.streaming import watermark_report

    src = write_files(f"{scratch}/in", LATE_BATCHES)
    q = run_once(write_alerts(detect_alerts(stream(spark, src), Rules()), f"{scratch}/out",
                              f"{scratch}/ckpt", trigger=ONCE))
    report = watermark_report(q)
    assert sum(r["dropped_late_rows"] for r in report) == 5  # late2: 5 events x 5 windows, pre-aggregated
    assert [r["input_rows"] for r in report][:6] == [5] * 6
    assert report[-1]["watermark"] == "2025-11-03T11:50:50.000Z"


def test_stateful_restart_resumes_from_checkpoint(spark, scratch):
    """Run on the first files, stop, add the rest, resume: same alerts as one uninterrupted run."""
    first, rest = LATE_BATCHES[:3], LATE_BATCHES[3:]
    src = write_files(f"{scratch}/in", first)
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    run_once(write_alerts(detect_alerts(stream(spark, src), Rules()), out, ckpt, trigger=ONCE))
    before = counts(read_alerts(spark, out).collect())
    # more files arrive after the stop (later mtimes than the first three)
    base = time.time() - 1800
    for i, rows in enumerate(rest):
        path = os.path.join(src, f"late-{i:03d}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(path, (base + 10 * i, base + 10 * i))
    run_once(write_alerts(detect_alerts(stream(spark, src), Rules()), out, ckpt, trigger=ONCE))
    after = counts(read_alerts(spark, out).collect())
    assert before == {"u": 5, "late1": 5}  # watermark 10:50:50: w's windows (to 11:05) still open
    assert after == {"u": 5, "w": 5, "late1": 5, "late3": 5}  # as in the uninterrupted run


def test_fused_rules_keep_one_state_store(spark, scratch):
    from tripwire.operators import detect_alerts_union

    src = write_files(f"{scratch}/in", LATE_BATCHES[:2])
    fused = run_once(write_alerts(detect_alerts(stream(spark, src), Rules()), f"{scratch}/a", f"{scratch}/ca",
                                  trigger=ONCE))
    union = run_once(write_alerts(detect_alerts_union(stream(spark, src), Rules()), f"{scratch}/b",
                                  f"{scratch}/cb", trigger=ONCE))
    assert len(fused.lastProgress["stateOperators"]) == 1
    assert len(union.lastProgress["stateOperators"]) == 3
    assert counts(read_alerts(spark, f"{scratch}/a").collect()) == counts(read_alerts(spark, f"{scratch}/b").collect())


def test_continuous_pipeline_picks_up_new_files(spark, scratch):
    """Processing-time trigger: files arriving while the queries run are processed."""
    def payload(i, minute, user="u"):
        return json.dumps({"event_id": f"{minute}-{i}", "timestamp": f"2025-11-03T{minute}:{10 + i:02d}Z",
                           "user_id": user, "session_id": "s", "ip_address": "i", "action": "login_failed"})

    src = f"{scratch}/raw"
    os.makedirs(src)
    raw = spark.readStream.text(src)
    spec = PipelineSpec(events_path=f"{scratch}/events", alerts_path=f"{scratch}/alerts",
                        checkpoint_base=f"{scratch}/ckpt", rules=Rules(), trigger={"processingTime": "1 second"})
    queries = start_pipeline(spark, raw, spec)
    try:
        with open(f"{src}/a.json", "w") as f:
            f.write("\n".join(payload(i, "10:00") for i in range(5)) + "\n")
        for q in queries:
            q.processAllAvailable()
        assert read_alerts(spark, f"{scratch}/alerts").count() == 0  # windows still open
        with open(f"{src}/b.json", "w") as f:
            f.write(payload(0, "10:30", user="z") + "\n")
        for q in queries:
            q.processAllAvailable()
        assert all(q.isActive for q in queries)
    finally:
        stop_all(queries)
    assert read_events(spark, f"{scratch}/events").count() == 6
    assert read_alerts(spark, f"{scratch}/alerts").count() == 5  # closed by the 10:30 event


def test_state_partitions_apply_to_the_query_only(spark, scratch):
    src = write_files(f"{scratch}/in", LATE_BATCHES[:2])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = run_once(write_alerts(detect_alerts(stream(spark, src), Rules()), f"{scratch}/a", f"{scratch}/ca",
                              trigger=ONCE, state_partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert q.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3


def test_union_in_update_mode_re_emits_only_the_changed_rule(spark, scratch):
    from tripwire.operators import detect_alerts_union

    src = write_files(f"{scratch}/in", WATERMARK_BATCHES)
    run_once(collect_updates(spark, detect_alerts_union(stream(spark, src), WM_RULES), f"{scratch}/update"))
    updates = spark.read.parquet(f"{scratch}/update")
    assert updates.count() == 10  # logins once (batch a), clicks once (batch b)
    key = ("window_start", "window_end", "user_id", "ip_address", "anomaly_type", "event_count")
    latest = sorted(tuple(r[k] for k in key) for r in latest_alerts(updates).collect())
    batch = detect_alerts(spark.read.schema(SCHEMA).json(src), WM_RULES)
    assert latest == sorted(tuple(r[k] for k in key) for r in batch.collect())


def test_incremental_backfill_over_events_at_rest(spark, scratch):
    """Events at rest read as a stream with availableNow: bounded batches, progress in the checkpoint."""
    src = write_files(f"{scratch}/in", LATE_BATCHES[:2])
    batch = spark.read.schema(SCHEMA).json(src)
    rest = f"{scratch}/rest"
    batch.write.partitionBy("action").parquet(rest)
    live = read_events(spark, rest, streaming=True, max_files_per_trigger=1).withWatermark("event_time", "10 minutes")
    q = run_once(write_alerts(detect_alerts(live, Rules()), f"{scratch}/out", f"{scratch}/ck", trigger=ONCE))
    assert counts(read_alerts(spark, f"{scratch}/out").collect()) == {"u": 5}  # w's windows still open
    assert sum(p["numInputRows"] for p in q.recentProgress) == 10


def test_stream_parses_each_payload_once(spark, scratch):
    lines = [json.dumps({"event_id": str(i), "timestamp": f"2025-11-03T10:00:{10 + i:02d}Z", "user_id": "u",
                         "session_id": "s", "ip_address": "i", "action": "login_failed"}) for i in range(5)]
    src = write_files(f"{scratch}/raw", [lines], as_text=True)
    live = detect_alerts(parse_events(spark.readStream.text(src), "10 minutes"), Rules())
    q = run_once(write_alerts(live, f"{scratch}/out", f"{scratch}/ck", trigger=ONCE))
    plan = q._jsq.explainInternal(False)
    assert plan.count("from_json") == 1 and "EventTimeWatermark" in plan
    assert plan.count("StateStoreSave") == 1


def test_run_once_timeout_stops_a_query_that_does_not_finish(spark, scratch):
    src = write_files(f"{scratch}/in", [logins("u", "10:00")])
    endless = write_alerts(detect_alerts(stream(spark, src), Rules()), f"{scratch}/o", f"{scratch}/c",
                           trigger={"processingTime": "1 second"})
    with pytest.raises(TimeoutError):
        run_once(endless, timeout=3)
    assert not endless.isActive


def test_pipeline_alerts_from_the_event_sink(spark, scratch):
    """alerts_from_events: the alert query reads the event sink's committed output (parse once)."""
    lines = []
    for minute in ("10:00", "10:20"):
        for s in range(10, 60, 10):
            lines.append(json.dumps({"event_id": f"{minute}-{s}", "timestamp": f"2025-11-03T{minute}:{s:02d}Z",
                                     "user_id": "u", "session_id": "s", "ip_address": "i",
                                     "action": "login_failed"}))
    src = write_files(f"{scratch}/raw", [lines[:5], lines[5:]], as_text=True)
    results = {}
    for from_events in (False, True):
        out = f"{scratch}/{from_events}"
        raw = spark.readStream.option("maxFilesPerTrigger", "1").text(src)
        spec = PipelineSpec(events_path=f"{out}/events", alerts_path=f"{out}/alerts", checkpoint_base=f"{out}/ck",
                            rules=Rules(), trigger=ONCE, alerts_from_events=from_events)
        queries = start_pipeline(spark, raw, spec)
        try:
            for q in queries:
                run_once(q)
        finally:
            stop_all(queries)
        key = ("window_start", "user_id", "ip_address", "anomaly_type", "event_count")
        results[from_events] = sorted(tuple(r[k] for k in key) for r in read_alerts(spark, f"{out}/alerts").collect())
        if from_events:
            plan = queries[1]._jsq.explainInternal(False)
            assert "from_json" not in plan  # the alert query reads parsed Parquet columns
    assert len(results[False]) == 5 and results[True] == results[False]


def test_continuous_alerts_from_the_event_sink(spark, scratch):
    """Seed with a run-once start, then run continuously: the alert query keeps reading the event
    sink's output from its checkpoint. Starting on an empty event folder is refused."""
    def payload(i, minute, user="u"):
        return json.dumps({"event_id": f"{minute}-{i}", "timestamp": f"2025-11-03T{minute}:{10 + i:02d}Z",
                           "user_id": user, "session_id": "s", "ip_address": "i", "action": "login_failed"})

    src = f"{scratch}/raw"
    os.makedirs(src)
    paths = dict(events_path=f"{scratch}/events", alerts_path=f"{scratch}/alerts", checkpoint_base=f"{scratch}/ckpt")
    live = PipelineSpec(**paths, rules=Rules(), trigger={"processingTime": "1 second"}, alerts_from_events=True)
    with pytest.raises(ValueError):
        start_pipeline(spark, spark.readStream.text(src), live)
    with open(f"{src}/a.json", "w") as f:
        f.write("\n".join(payload(i, "10:00") for i in range(5)) + "\n")
    seed = PipelineSpec(**paths, rules=Rules(), trigger=ONCE, alerts_from_events=True)
    for q in start_pipeline(spark, spark.readStream.text(src), seed):
        run_once(q)
    queries = start_pipeline(spark, spark.readStream.text(src), live)
    try:
        with open(f"{src}/b.json", "w") as f:
            f.write("\n".join(payload(i, "10:30", user="z") for i in range(5)) + "\n")
        for q in queries:  # events first: the alert query reads what the event query committed
            q.processAllAvailable()
        assert "from_json" not in queries[1]._jsq.explainInternal(False)
    finally:
        stop_all(queries)
    assert read_events(spark, f"{scratch}/events").count() == 10
    assert read_alerts(spark, f"{scratch}/alerts").count() == 5  # u's windows, closed by z at 10:30
