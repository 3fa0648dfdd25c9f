"""The live job (ST7): parse -> watermark -> fused rules -> sinks, several
queries started together, waited on, and stopped together.

One parsed frame feeds every sink. The alert query uses the fused rule
(one source scan and one state store per query instead of three).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripwire.operators.parse import parse_events, split_events
from tripwire.operators.rules import detect_alerts
from tripwire.schemas import ALERTS_TOPIC, EVENTS_TOPIC, Rules
from tripwire.session import checkpoint_root, ensure_utc
from tripwire.sources.parquet import read_events
from tripwire.streaming.live import AlertFanOut
from tripwire.streaming.sinks import (
    session_conf,
    write_alerts,
    write_alerts_kafka,
    write_console,
    write_events,
    write_rejected,
)


@dataclass
class PipelineSpec:
    """Where the live job writes, which rules it applies, and how it triggers."""

    events_path: str
    alerts_path: str
    checkpoint_base: str | None = None  # default: <spark.checkpoint.dir>/tripwire
    rules: Rules = field(default_factory=Rules)
    kafka_bootstrap_servers: str | None = None
    alerts_topic: str = ALERTS_TOPIC
    console: bool = False
    trigger: dict | None = None
    events_by_date: bool = False
    rocksdb_state: bool = False  # keep window state in RocksDB (large key sets) instead of the JVM heap
    rejected_path: str | None = None  # dead-letter sink for payloads that do not parse (or validate)
    validation_level: str | None = None  # "core" / "strict": also reject events missing required fields
    state_partitions: int | None = None  # window-state partitions of new alert queries (default: session's)
    event_files_per_folder: int | None = None  # salted repartition of the event sink (fewer, larger files)
    # Alerts from the event sink's committed Parquet output instead of the raw source: each payload
    # is parsed once (not once per query), and the alert query reads 5 of the 14 columns. (All action
    # folders are read: every event must advance the watermark.) Costs one trigger interval of
    # latency; late rows are judged on the sink's batch boundaries. The event folder must hold data
    # when the alert query first starts (seed it with a run-once start); an empty one is refused.
    alerts_from_events: bool = False
    # All alert sinks from one stateful aggregate (``live.AlertFanOut``): ``alerts_path`` then holds ``alerts`` (closed windows),
    # ``updates`` (every change) and the commits, and Kafka and the console are fed from the same batches. One source read
    # and one state store whatever the number of sinks. Fixed at the first start: a checkpoint belongs to one of the two forms.
    one_aggregate: bool = False


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_pipeline(spark: SparkSession, raw: DataFrame, spec: PipelineSpec) -> list[StreamingQuery]:
    """Start the event sink, the alert Parquet sink and, if configured, the
    alert Kafka sink, the rejected-payload sink and the console sink. On a
    failure to start any of them, the ones already running are stopped."""
    ensure_utc(spark)  # offset-free event times and the alert JSON are read / written in UTC
    base = (spec.checkpoint_base or f"{checkpoint_root(spark)}/tripwire").rstrip("/")
    rejected = None
    if spec.rejected_path or spec.validation_level:
        events, rejected = split_events(raw, spec.validation_level, spec.rules.watermark)
    else:
        events = parse_events(raw, spec.rules.watermark)
    queries: list[StreamingQuery] = []
    # The state store provider is read when a stateful query first starts (and recorded in its
    # checkpoint), so it is set only while these queries start.
    provider = ROCKSDB_PROVIDER if spec.rocksdb_state else None
    try:
        events_query = write_events(events, spec.events_path, f"{base}/events_sink",
                                    by_date=spec.events_by_date, trigger=spec.trigger,
                                    query_name="events_parquet", files_per_folder=spec.event_files_per_folder)
        queries.append(events_query)
        if spec.alerts_from_events:
            # The alert query reads the event sink's committed output (the file source follows the
            # sink's commit log). A run-once alert query sees only what is committed when it starts,
            # so it waits for the run-once event query. A file source also fixes its partition
            # columns when it starts, so the partition folders must exist already. The alert
            # query's source must then stay the same for its checkpoint: no silent fallback.
            if (spec.trigger or {}).get("availableNow"):
                run_once(events_query, timeout=None)
            if not _has_partitioned_output(spark, spec.events_path, ["action"]):
                raise ValueError(
                    f"alerts_from_events: {spec.events_path} holds no event data yet; seed it with a "
                    "run-once start (trigger availableNow) first, or run without alerts_from_events")
            source = read_events(spark, spec.events_path, streaming=True, by_date=spec.events_by_date)
            alerts = detect_alerts(source.withWatermark("event_time", spec.rules.watermark), spec.rules)
        else:
            alerts = detect_alerts(events, spec.rules)
        with session_conf(spark, "spark.sql.streaming.stateStore.providerClass", provider):
            if spec.one_aggregate:
                queries.append(_fan_out(spec).start(alerts, f"{base}/alerts_fan_out", trigger=spec.trigger,
                                                    query_name="alerts_fan_out", state_partitions=spec.state_partitions))
            else:
                _start_alert_queries(queries, alerts, spec, base)
        if spec.rejected_path:
            queries.append(write_rejected(rejected, spec.rejected_path, f"{base}/rejected",
                                          trigger=spec.trigger, query_name="rejected_parquet"))
        if spec.console and not spec.one_aggregate:
            queries.append(write_console(alerts, "alerts_console"))
    except Exception:
        stop_all(queries)
        raise
    return queries


def _start_alert_queries(queries: list[StreamingQuery], alerts: DataFrame, spec: PipelineSpec, base: str) -> None:
    """A query with a state store of its own for each alert sink."""
    queries.append(write_alerts(alerts, spec.alerts_path, f"{base}/alerts_closed", trigger=spec.trigger,
                                query_name="alerts_parquet", state_partitions=spec.state_partitions))
    if spec.kafka_bootstrap_servers:
        queries.append(write_alerts_kafka(alerts, spec.kafka_bootstrap_servers, spec.alerts_topic,
                                          f"{base}/alerts_messages", trigger=spec.trigger,
                                          query_name="alerts_kafka", state_partitions=spec.state_partitions))


def _fan_out(spec: PipelineSpec) -> AlertFanOut:
    also = []
    if spec.kafka_bootstrap_servers:
        also.append(lambda batch, _: write_alerts_kafka(batch, spec.kafka_bootstrap_servers, spec.alerts_topic))
    if spec.console:
        also.append(lambda batch, _: batch.show(1000, truncate=False))
    return AlertFanOut(spec.alerts_path, also)


def _has_partitioned_output(spark: SparkSession, path: str, partition_cols: list[str]) -> bool:
    """Whether ``path`` holds committed data with the given partition folders. Any other failure than missing data is raised."""
    try:
        return set(partition_cols) <= set(spark.read.parquet(path).columns)
    except AnalysisException as error:
        # an empty folder or sink log has its message only, no condition of its own
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or "nable to infer schema" in str(error):
            return False
        raise


def stop_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if q.isActive:
            q.stop()


def await_pipeline(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until any of ``queries`` ends (or ``timeout`` seconds pass); then, or
    on interrupt or error, stop them all. A query that failed re-raises its
    error here.

    The session's ``awaitAnyTermination`` also returns for queries that ended
    earlier, so this waits in short slices until one of *these* queries is down.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while all(q.isActive for q in queries):
            if deadline is not None and time.monotonic() >= deadline:
                break
            spark.streams.resetTerminated()
            spark.streams.awaitAnyTermination(1.0)
        for q in queries:
            if q.exception() is not None:
                raise q.exception()
    finally:
        stop_all(queries)


def run_once(query: StreamingQuery, timeout: float | None = 600.0) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; raise if it failed, or if it
    is still running after ``timeout`` seconds (``None``: wait as long as it takes)."""
    if timeout is None:
        query.awaitTermination()
        finished = True
    else:
        finished = query.awaitTermination(timeout)
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout}s")
    if query.exception() is not None:
        raise query.exception()
    return query


def watermark_report(query: StreamingQuery) -> list[dict]:
    """Per recent micro-batch: batch id, input rows, event-time watermark and the
    rows each stateful operator dropped as too late (ST3). The late count is of
    partially aggregated (window, key) rows, not of input events."""
    out = []
    for p in query.recentProgress:
        out.append({
            "batch_id": p["batchId"],
            "input_rows": p.get("numInputRows", 0),
            "watermark": p.get("eventTime", {}).get("watermark"),
            "dropped_late_rows": sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", [])),
            "state_rows": sum(s.get("numRowsTotal", 0) for s in p.get("stateOperators", [])),
        })
    return out


def main(argv: list[str] | None = None) -> int:
    """Run the live job (the reference's streaming entry point).

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \\
        --py-files tripwire.zip tripwire/streaming/job.py --bootstrap-servers broker:9092 \\
        --events-path s3a://bucket/events --alerts-path s3a://bucket/anomalies

    (locally: ``python -m tripwire.streaming.job ...``)

    Cluster settings (master, shuffle partitions, checkpoint folder, S3
    credentials) come from spark-submit, not from here. ``--source-dir`` reads
    JSON-lines files instead of Kafka; ``--once`` processes what is there and
    stops (availableNow).
    """
    import argparse

    from tripwire.sources.kafka import read_events_kafka

    ap = argparse.ArgumentParser(prog="tripwire.streaming.job")
    ap.add_argument("--bootstrap-servers")
    ap.add_argument("--topic", default=None)
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--min-partitions", type=int, help="Kafka: split topic partitions over at least this many tasks")
    ap.add_argument("--max-offsets-per-trigger", type=int, help="Kafka: bound each micro-batch")
    ap.add_argument("--source-dir", help="JSON-lines folder instead of Kafka")
    ap.add_argument("--events-path", required=True)
    ap.add_argument("--alerts-path", required=True)
    ap.add_argument("--checkpoint-base")
    ap.add_argument("--kafka-alerts", action="store_true", help="also publish alerts to Kafka (update mode)")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--rocksdb-state", action="store_true")
    ap.add_argument("--rejected-path", help="dead-letter folder for payloads that do not parse")
    ap.add_argument("--validation-level", choices=("core", "strict"))
    ap.add_argument("--state-partitions", type=int, help="window-state partitions of a new alert query")
    ap.add_argument("--event-files-per-folder", type=int, help="about this many event files per folder and batch")
    ap.add_argument("--events-by-date", action="store_true", help="partition events by action and date")
    ap.add_argument("--one-aggregate", action="store_true", help="all alert sinks from one query and state store")
    ap.add_argument("--alerts-from-events", action="store_true",
                    help="alert query reads the event sink's output (parse once)")
    args = ap.parse_args(argv)
    if not args.source_dir and not args.bootstrap_servers:
        ap.error("give --bootstrap-servers or --source-dir")
    if args.kafka_alerts and not args.bootstrap_servers:
        ap.error("--kafka-alerts needs --bootstrap-servers")

    spark = SparkSession.builder.appName("tripwire").getOrCreate()
    if args.source_dir:
        raw = spark.readStream.text(args.source_dir)
    else:
        raw = read_events_kafka(spark, args.bootstrap_servers, args.topic or EVENTS_TOPIC, args.starting_offsets,
                                min_partitions=args.min_partitions,
                                max_offsets_per_trigger=args.max_offsets_per_trigger)
    spec = PipelineSpec(
        events_path=args.events_path,
        alerts_path=args.alerts_path,
        checkpoint_base=args.checkpoint_base,
        kafka_bootstrap_servers=args.bootstrap_servers if args.kafka_alerts else None,
        console=args.console,
        trigger={"availableNow": True} if args.once else None,
        rocksdb_state=args.rocksdb_state,
        rejected_path=args.rejected_path,
        validation_level=args.validation_level,
        state_partitions=args.state_partitions,
        event_files_per_folder=args.event_files_per_folder,
        events_by_date=args.events_by_date,
        alerts_from_events=args.alerts_from_events,
        one_aggregate=args.one_aggregate,
    )
    queries = start_pipeline(spark, raw, spec)
    try:
        if args.once:
            for q in queries:
                run_once(q, timeout=None)  # a backlog takes as long as it takes
        else:
            await_pipeline(spark, queries)
    except KeyboardInterrupt:
        stop_all(queries)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
