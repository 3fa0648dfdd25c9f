"""Named end-to-end plans over the driver's test tables.

Each plan reads the whole ``events`` table of one scale directory as raw
payload records (see ``tripwire.sources.tables``), runs the operators, and
returns a lazy DataFrame in a comparable form: timestamps as zone-free
TIMESTAMP_NTZ (UTC), alert counts as INT, totals as BIGINT, money rounded to cents, and the
per-micro-batch ``detection_timestamp`` either dropped or replaced by a value
derived from the data.

The reference's five-minute windows give no alerts on this table (about 67
events per user per month), so these plans use day-scale windows and lower
thresholds (``DRIVER_RULES``); the operators' defaults stay the reference's.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.functions import as_ntz
from tripwire.operators import (
    alert_feed,
    alert_kpis,
    alerts_by_type,
    brute_force,
    click_burst,
    decode_alerts,
    decode_events,
    detect_alerts,
    detect_alerts_panes,
    detect_alerts_union,
    encode_alerts,
    encode_events,
    event_count,
    first_alerts,
    latest_alerts,
    parse_events,
    recent_alerts,
    recent_events,
    rejected_events,
    top_ips,
    latest_event_time,
    new_alerts,
    trailing_alerts,
    transaction_velocity,
    validate_events,
)
from tripwire.operators.alerts import REFERENCE_FIRST_KEYS
from tripwire.schemas import EVENT_FIELDS, Rules
from tripwire.session import ensure_utc, scratch_path
from tripwire.sources import read_alert_updates, read_alerts, read_event_records, read_event_slices, read_events, read_split
from tripwire.streaming import (
    AlertFanOut,
    AlertLog,
    EventStore,
    LatestView,
    PipelineSpec,
    TrailingStore,
    WindowStore,
    recent_alert_rows,
    recent_event_rows,
    replay,
    run_once,
    start_pipeline,
    stop_all,
    write_alert_updates,
    write_alerts,
    write_events,
    write_split,
)

# The test tables are files of one row group, which a scan can't split. A caller with more cores than row groups
# (bench.py) may have their rows dealt out to so many tasks; by default the scan stays as it is.
PARTS_CONF = "spark.tripwire.parts"
# Rule parameters for the driver's events table.
DRIVER_RULES = Rules(
    window="5 days",
    slide="1 day",
    watermark="10 minutes",
    max_failed_logins=3,
    max_transaction_velocity=3,
    max_transaction_amount=200.0,
    max_clicks_per_window=4,
    trailing_minutes=5 * 24 * 60,
    trailing_failed_logins=3,
    trailing_transaction_velocity=3,
    trailing_transaction_amount=200.0,
    trailing_clicks_per_ip=20,
)

EVENT_COLUMNS = tuple(n for n, _, _ in EVENT_FIELDS)


# ---------------------------------------------------------------- projections

def comparable_events(events: DataFrame) -> DataFrame:
    return events.select(*EVENT_COLUMNS, as_ntz("event_time").alias("event_time"))


def comparable_alerts(alerts: DataFrame, stamp: bool = False) -> DataFrame:
    cols: list[Column | str] = [
        as_ntz("window_start").alias("window_start"),
        as_ntz("window_end").alias("window_end"),
        "user_id", "ip_address", "anomaly_type", "severity",
        F.col("event_count").cast("int").alias("event_count"),
        F.round("total_amount", 2).alias("total_amount"),
        "details",
    ]
    if stamp:
        cols.append(as_ntz("detection_timestamp").alias("detection_timestamp"))
    return alerts.select(*cols)


def stamped(alerts: DataFrame) -> DataFrame:
    """Replace the per-batch processing stamp by the window end (data-derived)."""
    return alerts.withColumn("detection_timestamp", F.col("window_end"))


# ---------------------------------------------------------------- inputs

def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get(PARTS_CONF, "0"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return read_event_records(spark, sf_dir, parts=_parts(spark))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(records(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_alerts(events(spark, sf_dir), DRIVER_RULES)


def _state_partitions(spark: SparkSession) -> int:
    # The test tables are small: one state partition per core, not the session's default.
    return spark.sparkContext.defaultParallelism


# ---------------------------------------------------------------- plans

def q_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_events(events(spark, sf_dir))


def q_rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_events(records(spark, sf_dir)).select("event_id", "user_id", "action", "reject_reason")


def q_validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per validation level and field: how many records lack that field."""
    return _errors_by_field(records(spark, sf_dir))


def _errors_by_field(raw: DataFrame) -> DataFrame:
    decoded = decode_events(raw)
    checked = validate_events(validate_events(decoded, "core", column="core"), "strict", column="strict")
    per_level = checked.select(F.inline(F.array(
        F.struct(F.lit("core").alias("level"), F.col("core").alias("errors")),
        F.struct(F.lit("strict").alias("level"), F.col("strict").alias("errors")),
    )))
    return (
        per_level.select("level", F.explode("errors").alias("field"))
        .groupBy("level", "field")
        .agg(F.count(F.lit(1)).cast("int").alias("n_events"))
    )


def q_brute_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(brute_force(events(spark, sf_dir), DRIVER_RULES))


def q_transaction_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(transaction_velocity(events(spark, sf_dir), DRIVER_RULES))


def q_click_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(click_burst(events(spark, sf_dir), DRIVER_RULES))


def q_detect_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(alerts(spark, sf_dir))


def q_detect_alerts_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(detect_alerts_union(events(spark, sf_dir), DRIVER_RULES))


def q_pane_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 from panes: windows are put together behind the shuffle."""
    return comparable_alerts(detect_alerts_panes(events(spark, sf_dir), DRIVER_RULES))


def q_pane_alerts_long_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 from panes with windows of 20 half-day slides, per user only."""
    long = DRIVER_RULES.with_(window="10 days", slide="12 hours", max_failed_logins=6, max_transaction_velocity=6,
                              max_transaction_amount=600.0, max_clicks_per_window=10)
    return comparable_alerts(detect_alerts_panes(events(spark, sf_dir), long, keys=("user_id",)))


def q_per_user_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 keyed by user only: a burst spread over several IPs still counts."""
    return comparable_alerts(transaction_velocity(events(spark, sf_dir), DRIVER_RULES, keys=("user_id",)))


def q_tumbling_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 with slide equal to the window: one-day tumbling windows."""
    return comparable_alerts(detect_alerts(events(spark, sf_dir), DRIVER_RULES.with_(window="1 day", slide="1 day")))


def q_split_valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 split in one write, valid side."""
    path = scratch_path(spark, "split")
    write_split(records(spark, sf_dir), path)
    return comparable_events(read_split(spark, path)[0])


def partial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads with single fields missing."""
    ensure_utc(spark)
    return read_event_records(spark, sf_dir, parts=_parts(spark), partial=True)


def q_split_rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 split in one write, rejected side: three reasons."""
    path = scratch_path(spark, "split")
    write_split(partial_records(spark, sf_dir), path, level="core")
    return read_split(spark, path)[1].select("event_id", "user_id", "action", "reject_reason")


def q_partial_rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V3: records that lack a timestamp or any other field at all."""
    return rejected_events(partial_records(spark, sf_dir), level="strict").select("event_id", "user_id", "action", "reject_reason")


def q_partial_validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2: per validation level and field, how many records lack it."""
    return _errors_by_field(partial_records(spark, sf_dir))


def q_default_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 with V1: parsed events with a missing amount taken as 0, and the names of what else is missing."""
    checked = validate_events(parse_events(partial_records(spark, sf_dir)), "strict", default_amount=True)
    return checked.select("event_id", as_ntz("event_time").alias("event_time"), "amount", F.array_join("errors", ",").alias("errors"))


def q_alert_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9: all alerts of a run carry one detection stamp, the run's own time."""
    before = datetime.now(timezone.utc)
    stamp = F.col("detection_timestamp")
    return alerts(spark, sf_dir).groupBy("anomaly_type").agg(
        F.count("*").alias("n_alerts"), F.countDistinct(stamp).alias("n_stamps"),
        ((F.min(stamp) >= F.lit(before)) & (F.max(stamp) <= F.current_timestamp())).alias("stamped_now"))


def q_trailing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    return comparable_alerts(trailing_alerts(ev, DRIVER_RULES, as_of=latest_event_time(ev)), stamp=True)


def q_new_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 against a log that holds the alerts of windows before the middle of the table's time."""
    every = stamped(alerts(spark, sf_dir))
    middle = every.select(F.timestamp_seconds((F.min(F.unix_timestamp("window_start")) + F.max(F.unix_timestamp("window_start"))) / 2)).scalar()
    recorded = every.filter(F.col("window_start") < middle)
    return comparable_alerts(new_alerts(every, recorded, REFERENCE_FIRST_KEYS), stamp=True)


def q_first_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard dedup key (user, type, window end): one IP kept per key."""
    return comparable_alerts(first_alerts(stamped(alerts(spark, sf_dir)), REFERENCE_FIRST_KEYS), stamp=True)


def q_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alert in two versions (count - 1 one minute earlier, then the final
    one), as update-mode output delivers them; the latest must be the final."""
    a = stamped(alerts(spark, sf_dir))
    versions = a.withColumn("v", F.explode(F.array(
        F.struct(F.col("event_count").alias("c"), F.col("detection_timestamp").alias("t")),
        F.struct((F.col("event_count") - 1).alias("c"),
                 (F.col("detection_timestamp") - F.expr("INTERVAL 1 MINUTE")).alias("t")),
    ))).withColumn("event_count", F.col("v.c")).withColumn("detection_timestamp", F.col("v.t")).drop("v")
    return comparable_alerts(latest_alerts(versions), stamp=True)


def q_recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(recent_alerts(stamped(alerts(spark, sf_dir)), 200), stamp=True)


def q_alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = alert_feed(stamped(alerts(spark, sf_dir)), 30)
    return feed.withColumn("detection_timestamp", as_ntz("detection_timestamp")).withColumn(
        "total_amount", F.round("total_amount", 2))


def q_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_events(recent_events(events(spark, sf_dir), 1000))


def q_alert_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_kpis(alerts(spark, sf_dir))


def q_buffer_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's KPI cards: computed over the newest 200 alerts only."""
    return alert_kpis(recent_alerts(stamped(alerts(spark, sf_dir)), 200))


def q_event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_count(events(spark, sf_dir))


def q_alerts_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_by_type(alerts(spark, sf_dir))


def q_top_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_ips(alerts(spark, sf_dir), 6)


def q_encode_alerts_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_alerts(decode_alerts(encode_alerts(alerts(spark, sf_dir))))


def q_encode_events_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_events(parse_events(encode_events(events(spark, sf_dir))))


def q_stream_events_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S3: a real stream (availableNow) of the payload records, parsed with
    the watermark, written to Parquet by action, read back."""
    ensure_utc(spark)
    base = scratch_path(spark, "stream_events")
    raw = read_event_records(spark, sf_dir, streaming=True, parts=_parts(spark))
    parsed = parse_events(raw, DRIVER_RULES.watermark)
    run_once(write_events(parsed, f"{base}/events", f"{base}/_checkpoint", trigger={"availableNow": True}))
    return comparable_events(read_events(spark, f"{base}/events"))


def q_backfill_from_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> S3 -> A4: the live job's event folders (by action) read back as a batch and
    run through the rules; the rules' action filter prunes the folders."""
    ensure_utc(spark)
    base = scratch_path(spark, "backfill")
    raw = read_event_records(spark, sf_dir, streaming=True, parts=_parts(spark))
    run_once(write_events(parse_events(raw, DRIVER_RULES.watermark), f"{base}/events", f"{base}/_checkpoint",
                          trigger={"availableNow": True}))
    at_rest = read_events(spark, f"{base}/events")
    return comparable_alerts(detect_alerts(at_rest, DRIVER_RULES))


def q_stream_alerts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1-ST6 + K2: streaming fused rules in append mode to Parquet; only the
    windows the watermark has closed come out."""
    ensure_utc(spark)
    base = scratch_path(spark, "stream_alerts")
    raw = read_event_records(spark, sf_dir, streaming=True, parts=_parts(spark))
    live = detect_alerts(parse_events(raw, DRIVER_RULES.watermark), DRIVER_RULES)
    run_once(write_alerts(live, f"{base}/alerts", f"{base}/_checkpoint", trigger={"availableNow": True},
                          state_partitions=_state_partitions(spark)))
    return comparable_alerts(read_alerts(spark, f"{base}/alerts"))


def q_stream_first_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a stream: first-wins dedup sharing the rules' watermark, in append mode."""
    ensure_utc(spark)
    base = scratch_path(spark, "stream_first")
    raw = read_event_records(spark, sf_dir, streaming=True, parts=_parts(spark))
    live = detect_alerts(parse_events(raw, DRIVER_RULES.watermark), DRIVER_RULES, keep_window=True)
    run_once(write_alerts(first_alerts(live), f"{base}/alerts", f"{base}/_checkpoint",
                          trigger={"availableNow": True}, state_partitions=_state_partitions(spark)))
    return comparable_alerts(read_alerts(spark, f"{base}/alerts"))


def q_pipeline_alerts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 end to end: the live job (run once) with the alert query fed from the event sink's
    committed output, so each payload is parsed once; closed windows come out."""
    ensure_utc(spark)
    base = scratch_path(spark, "live_job")
    raw = read_event_records(spark, sf_dir, streaming=True, parts=_parts(spark))
    spec = PipelineSpec(events_path=f"{base}/events", alerts_path=f"{base}/alerts", checkpoint_base=f"{base}/_ck",
                        rules=DRIVER_RULES, trigger={"availableNow": True}, alerts_from_events=True,
                        state_partitions=_state_partitions(spark))
    queries = start_pipeline(spark, raw, spec)
    try:
        for q in queries:
            run_once(q)
    finally:
        stop_all(queries)
    return comparable_alerts(read_alerts(spark, f"{base}/alerts"))


def q_stream_alerts_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 update mode (the Kafka alert path) + D2: every change of every window
    is logged as it happens; the latest version of each alert is the batch result."""
    ensure_utc(spark)
    base = scratch_path(spark, "stream_updates")
    raw = read_event_records(spark, sf_dir, streaming=True, parts=_parts(spark))
    live = detect_alerts(parse_events(raw, DRIVER_RULES.watermark), DRIVER_RULES)
    run_once(write_alert_updates(live, f"{base}/updates", f"{base}/_checkpoint", trigger={"availableNow": True},
                                 state_partitions=_state_partitions(spark)))
    return comparable_alerts(latest_alerts(read_alert_updates(spark, f"{base}/updates").drop("batch_id")))


# ---------------------------------------------------------------- several runs over one checkpoint
# The table comes in three slices, and every eleventh event only with the last: by then its windows may be closed.

def _replayed(spark: SparkSession, sf_dir: str, name: str, start) -> tuple[str, list]:
    """Run ``start(stream, base, state partitions)`` over each slice; the outputs lie under ``base``."""
    ensure_utc(spark)
    base = scratch_path(spark, name)
    reports = replay(spark, read_event_slices(spark, sf_dir), f"{base}/source", lambda raw: start(raw, base))
    return base, reports


def _once(spark: SparkSession) -> dict:
    return {"trigger": {"availableNow": True}, "state_partitions": _state_partitions(spark)}


def _live_alerts(raw: DataFrame) -> DataFrame:
    return detect_alerts(parse_events(raw, DRIVER_RULES.watermark), DRIVER_RULES)


def q_sliced_alerts_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, ST3, ST6: state and watermark carried over three runs; late (window, key) rows are left out."""
    base, _ = _replayed(spark, sf_dir, "sliced_append", lambda raw, base: write_alerts(
        _live_alerts(raw), f"{base}/alerts", f"{base}/_checkpoint", **_once(spark)))
    return comparable_alerts(read_alerts(spark, f"{base}/alerts"))


def q_sliced_window_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, ST3: the same windows from the store that accounts for late rows."""
    base = _window_store(spark, sf_dir)
    return comparable_alerts(WindowStore(f"{base}/store", DRIVER_RULES).alerts(spark))


def q_sliced_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 side output: each late event, how many of its windows were closed, and whether all were."""
    base = _window_store(spark, sf_dir)
    late = WindowStore(f"{base}/store", DRIVER_RULES).late_rows(spark)
    return late.select("event_id", "user_id", "action", as_ntz("event_time").alias("event_time"),
                       F.size("closed_windows").alias("n_closed"), "dropped", F.col("batch_id").cast("int").alias("batch_id"))


def _window_store(spark: SparkSession, sf_dir: str) -> str:
    store = lambda base: WindowStore(f"{base}/store", DRIVER_RULES)
    return _replayed(spark, sf_dir, "window_store", lambda raw, base: store(base).start(
        parse_events(raw), f"{base}/_checkpoint", **_once(spark)))[0]


def q_sliced_alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on a stream against the alert log: the version of each alert that fired first, over three runs of updates."""
    base, _ = _replayed(spark, sf_dir, "alert_log", lambda raw, base: AlertLog(f"{base}/log").start(
        _live_alerts(raw), f"{base}/_checkpoint", **_once(spark)))
    return comparable_alerts(AlertLog(f"{base}/log").alerts(spark))


def q_sliced_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2, ST5: the maintained view of the latest version of each alert, over three runs of updates."""
    base, _ = _replayed(spark, sf_dir, "latest_view", lambda raw, base: LatestView(f"{base}/view", buckets=16).start(
        _live_alerts(raw), f"{base}/_checkpoint", **_once(spark)))
    return comparable_alerts(LatestView(f"{base}/view", buckets=16).alerts(spark))


def q_sliced_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on a stream: the newest 1000 events after three runs."""
    base, _ = _replayed(spark, sf_dir, "newest_events", lambda raw, base: recent_event_rows(f"{base}/newest").start(
        parse_events(raw), f"{base}/_checkpoint", **_once(spark)))
    return comparable_events(recent_event_rows(f"{base}/newest").rows(spark))


def q_sliced_recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on a stream: the newest 200 alerts of closed windows after three runs."""
    base, _ = _replayed(spark, sf_dir, "newest_alerts", lambda raw, base: recent_alert_rows(f"{base}/newest").start(
        stamped(_live_alerts(raw)), f"{base}/_checkpoint", **_once(spark)))
    return comparable_alerts(recent_alert_rows(f"{base}/newest").rows(spark), stamp=True)


def q_sliced_compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: events of three runs by day, with the days that were over before the last run rewritten into single files."""
    store = lambda base: EventStore(f"{base}/events")
    ensure_utc(spark)
    base = scratch_path(spark, "event_store")
    slices = read_event_slices(spark, sf_dir)

    def start(raw):
        return store(base).start(parse_events(raw), f"{base}/_checkpoint", **_once(spark))

    replay(spark, slices[:2], f"{base}/source", start)
    latest = store(base).events(spark).agg(F.max(F.unix_micros("event_time"))).first()[0]
    store(base).compact(spark, latest)
    replay(spark, slices[2:], f"{base}/source", start)  # brings events of rewritten days too
    return comparable_events(store(base).events(spark))


def q_sliced_trailing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5-A7 on a stream: the trailing range's alerts after each of three runs, as of the latest event so far."""
    store = lambda base: TrailingStore(f"{base}/store", DRIVER_RULES, slot="1 day", clock=lambda latest: latest)
    base, _ = _replayed(spark, sf_dir, "trailing_store", lambda raw, base: store(base).start(
        parse_events(raw), f"{base}/_checkpoint", **_once(spark)))
    out = None
    for n in range(3):
        part = comparable_alerts(store(base).alerts(spark, n), stamp=True).withColumn("batch_id", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def q_sliced_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7, K2 + K3's log: final and changing alerts from one aggregate; ``sink`` names the output, the log reduced by D2."""
    base, _ = _replayed(spark, sf_dir, "fan_out", lambda raw, base: AlertFanOut(f"{base}/out").start(
        _live_alerts(raw), f"{base}/_checkpoint", **_once(spark)))
    out = AlertFanOut(f"{base}/out")
    final = comparable_alerts(out.alerts(spark)).withColumn("sink", F.lit("alerts"))
    log = comparable_alerts(latest_alerts(out.updates(spark).drop("batch_id"))).withColumn("sink", F.lit("updates"))
    return final.unionByName(log)


QUERIES = {
    "parse_events": q_parse_events,
    "rejected_events": q_rejected_events,
    "validation_errors": q_validation_errors,
    "brute_force": q_brute_force,
    "transaction_velocity": q_transaction_velocity,
    "click_burst": q_click_burst,
    "detect_alerts": q_detect_alerts,
    "detect_alerts_union": q_detect_alerts_union,
    "pane_alerts": q_pane_alerts,
    "pane_alerts_long_windows": q_pane_alerts_long_windows,
    "per_user_velocity": q_per_user_velocity,
    "tumbling_alerts": q_tumbling_alerts,
    "split_valid_events": q_split_valid_events,
    "trailing_alerts": q_trailing_alerts,
    "first_alerts": q_first_alerts,
    "new_alerts": q_new_alerts,
    "latest_alerts": q_latest_alerts,
    "recent_alerts": q_recent_alerts,
    "alert_feed": q_alert_feed,
    "recent_events": q_recent_events,
    "alert_kpis": q_alert_kpis,
    "buffer_kpis": q_buffer_kpis,
    "event_count": q_event_count,
    "alerts_by_type": q_alerts_by_type,
    "top_ips": q_top_ips,
    "encode_alerts_roundtrip": q_encode_alerts_roundtrip,
    "encode_events_roundtrip": q_encode_events_roundtrip,
    "stream_events_parquet": q_stream_events_parquet,
    "backfill_from_sink": q_backfill_from_sink,
    "stream_alerts_append": q_stream_alerts_append,
    "stream_alerts_update": q_stream_alerts_update,
    "stream_first_alerts": q_stream_first_alerts,
    "pipeline_alerts_from_events": q_pipeline_alerts_from_events,
    "split_rejected_events": q_split_rejected_events,
    "partial_rejected_events": q_partial_rejected_events,
    "partial_validation_errors": q_partial_validation_errors,
    "default_amounts": q_default_amounts,
    "alert_stamps": q_alert_stamps,
    "sliced_compacted_events": q_sliced_compacted_events,
    "sliced_alerts_append": q_sliced_alerts_append,
    "sliced_window_store": q_sliced_window_store,
    "sliced_late_rows": q_sliced_late_rows,
    "sliced_alert_log": q_sliced_alert_log,
    "sliced_latest_view": q_sliced_latest_view,
    "sliced_recent_events": q_sliced_recent_events,
    "sliced_recent_alerts": q_sliced_recent_alerts,
    "sliced_trailing_alerts": q_sliced_trailing_alerts,
    "sliced_fan_out": q_sliced_fan_out,
}
