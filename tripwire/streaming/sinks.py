"""Sinks (K1-K5) with trigger, output mode and checkpoint (ST4-ST6).

The Parquet and Kafka writers accept a streaming frame (and return the started
``StreamingQuery``) or a batch frame (written at once; returns ``None``), so a
backfill takes the same path as the live job. The console sink is stream-only. Streaming writers require a checkpoint location: the
query restarts from it after a failure or a lost executor, and the file sink's
commit log makes the output exactly-once.

Parquet sinks take append only: rows of windowed aggregates are final there
(emitted once the watermark passes the window end). The Kafka sink defaults to
update, i.e. early and repeated alerts; reduce them with ``latest_alerts``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripwire.operators.codec import encode_alerts, encode_events
from tripwire.operators.parse import classify_events
from tripwire.schemas import ALERTS_TOPIC, EVENTS_TOPIC, TRIGGER_INTERVAL, VALID

DEFAULT_TRIGGER = {"processingTime": TRIGGER_INTERVAL}


@contextmanager
def session_conf(spark: SparkSession, key: str, value: object | None) -> Iterator[None]:
    """Set a session setting for the duration of the block (no-op for ``None``)."""
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def state_partitions_for_start(spark: SparkSession, n: int | None):
    """Shuffle (and state store) partitions for a streaming query being started.

    A stateful query fixes this number at its first start and records it in its
    checkpoint; later restarts keep the recorded value. The session setting is
    changed only while the query starts.
    """
    return session_conf(spark, "spark.sql.shuffle.partitions", int(n) if n else None)


def _start(df: DataFrame, fmt: str, options: dict[str, str], checkpoint: str | None,
           trigger: dict | None, output_mode: str, partition_by: Sequence[str] = (),
           query_name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    writer = df.writeStream.format(fmt).options(**options).outputMode(output_mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(**(trigger or DEFAULT_TRIGGER))
    with state_partitions_for_start(df.sparkSession, state_partitions):
        return writer.start()


def _need_checkpoint(checkpoint: str | None) -> str:
    if not checkpoint:
        raise ValueError("a streaming sink needs a checkpoint location")
    return checkpoint


def write_events(events: DataFrame, path: str, checkpoint: str | None = None,
                 partition_by: Sequence[str] = ("action",), by_date: bool = False,
                 trigger: dict | None = None, query_name: str | None = None,
                 files_per_folder: int | None = None) -> StreamingQuery | None:
    """K1: parsed events to Parquet, partitioned by ``action`` (and by
    ``event_date`` with ``by_date``). Unaggregated, so late rows are kept.

    By default each task writes one file per folder it has rows for (no
    shuffle). With ``files_per_folder = m`` the events are first
    hash-partitioned on the folder columns plus a bucket of ``event_id`` (m
    buckets), so each micro-batch writes about m files per folder, and a hot
    folder is still spread over m tasks. That costs one shuffle of the events.
    """
    cols = list(partition_by)
    if by_date:
        events = events.withColumn("event_date", F.to_date("event_time"))
        cols.append("event_date")
    if files_per_folder:
        bucket = F.pmod(F.xxhash64("event_id"), F.lit(int(files_per_folder)))
        events = events.repartition(*[F.col(c) for c in cols], bucket)
    if events.isStreaming:
        return _start(events, "parquet", {"path": path}, _need_checkpoint(checkpoint), trigger,
                      "append", cols, query_name)
    events.write.mode("append").partitionBy(*cols).parquet(path)
    return None


def write_alerts(alerts: DataFrame, path: str, checkpoint: str | None = None,
                 trigger: dict | None = None, query_name: str | None = None,
                 state_partitions: int | None = None) -> StreamingQuery | None:
    """K2: alerts to Parquet, append (closed windows only on a stream).
    ``state_partitions`` sizes the window state of a new query (see
    :func:`state_partitions_for_start`)."""
    if alerts.isStreaming:
        return _start(alerts, "parquet", {"path": path}, _need_checkpoint(checkpoint), trigger,
                      "append", (), query_name, state_partitions)
    alerts.write.mode("append").parquet(path)
    return None


def write_rejected(rejected: DataFrame, path: str, checkpoint: str | None = None,
                   trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery | None:
    """Rejected payloads (from ``split_events``) to Parquet by ``reject_reason``:
    the dead-letter output of the parse step, kept whole for inspection or replay."""
    cols = ["payload", "event_id", "timestamp", "user_id", "action", "reject_reason"]
    out = rejected.select(*cols)
    if out.isStreaming:
        return _start(out, "parquet", {"path": path}, _need_checkpoint(checkpoint), trigger, "append",
                      ("reject_reason",), query_name)
    out.write.mode("append").partitionBy("reject_reason").parquet(path)
    return None


def write_split(raw: DataFrame, path: str, level: str | None = None, checkpoint: str | None = None,
                trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery | None:
    """V3: valid and rejected payloads in one write, so each payload is decoded once.

    Rows lie by ``outcome``: ``valid`` or the reject reason. ``sources.read_split``
    reads either side, and only its folders. The payload text is kept for rejected rows only.
    """
    reason = F.col("reject_reason")
    out = classify_events(raw, level).withColumn("outcome", F.coalesce(reason, F.lit(VALID))).withColumn(
        "payload", F.when(reason.isNotNull(), F.col("payload"))).drop("reject_reason")
    if out.isStreaming:
        return _start(out, "parquet", {"path": path}, _need_checkpoint(checkpoint), trigger, "append", ("outcome",), query_name)
    out.write.mode("append").partitionBy("outcome").parquet(path)
    return None


def write_alert_updates(alerts: DataFrame, path: str, checkpoint: str | None = None,
                        trigger: dict | None = None, query_name: str | None = None,
                        state_partitions: int | None = None) -> StreamingQuery | None:
    """Update-mode alerts (early and repeated, as the Kafka sink gets them) as a
    Parquet log, one ``batch_id=N`` folder per micro-batch.

    Each micro-batch overwrites its own folder, so a batch replayed after a
    failure replaces its first attempt instead of adding to it. Reduce the log
    with ``latest_alerts`` (read it with ``read_alert_updates``).
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    if not alerts.isStreaming:
        write_batch(alerts, 0)
        return None
    writer = (alerts.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", _need_checkpoint(checkpoint))
              .trigger(**(trigger or DEFAULT_TRIGGER)))
    if query_name:
        writer = writer.queryName(query_name)
    with state_partitions_for_start(alerts.sparkSession, state_partitions):
        return writer.start()


def kafka_sink_options(bootstrap_servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic,
            **{k: str(v) for k, v in extra.items()}}


def write_alerts_kafka(alerts: DataFrame, bootstrap_servers: str, topic: str = ALERTS_TOPIC,
                       checkpoint: str | None = None, trigger: dict | None = None,
                       output_mode: str = "update", query_name: str | None = None,
                       state_partitions: int | None = None) -> StreamingQuery | None:
    """K3: alerts as JSON messages keyed by user_id (update mode by default)."""
    messages = encode_alerts(alerts)
    options = kafka_sink_options(bootstrap_servers, topic)
    if messages.isStreaming:
        return _start(messages, "kafka", options, _need_checkpoint(checkpoint), trigger, output_mode,
                      (), query_name, state_partitions)
    messages.write.format("kafka").options(**options).save()
    return None


def write_events_kafka(events: DataFrame, bootstrap_servers: str, topic: str = EVENTS_TOPIC,
                       checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery | None:
    """K5: events as JSON messages keyed by user_id (one user's events stay in
    one partition, hence ordered)."""
    messages = encode_events(events)
    options = kafka_sink_options(bootstrap_servers, topic)
    if messages.isStreaming:
        return _start(messages, "kafka", options, _need_checkpoint(checkpoint), trigger, "append")
    messages.write.format("kafka").options(**options).save()
    return None


def write_console(df: DataFrame, query_name: str = "console_alerts", output_mode: str = "update",
                  trigger: dict | None = None) -> StreamingQuery:
    """K4: debug sink, untruncated rows, no checkpoint, default trigger."""
    writer = (df.writeStream.queryName(query_name).format("console").option("truncate", "false")
              .outputMode(output_mode))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
