"""Kafka sources (S1, S2). The Kafka connector jar must be on the classpath
(``spark.jars.packages``); without it ``load()`` fails with "Failed to find
data source: kafka". The option builders and decoders are plain functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwire.operators.codec import decode_alerts
from tripwire.schemas import ALERTS_TOPIC, EVENTS_TOPIC


def kafka_source_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                         fail_on_data_loss: bool = False, min_partitions: int | None = None,
                         max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Options of the reference's raw-event source (defaults: latest, no fail on loss).

    ``min_partitions`` splits large topic partitions over more Spark tasks, so a
    partition holding a hot key's messages is still read in parallel.
    ``max_offsets_per_trigger`` bounds a micro-batch, so a backlog (after a
    restart, say) is worked off in batches of known size, not one huge batch.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Kafka records (key, value, topic, partition, offset, timestamp, ...)."""
    reader = spark.readStream if streaming else spark.read
    if not streaming:
        if options.get("startingOffsets", "latest") == "latest":
            raise ValueError("a batch read can't start at the latest offset; give startingOffsets (say, earliest)")
    return reader.format("kafka").options(**options).load()


def read_events_kafka(spark: SparkSession, bootstrap_servers: str, topic: str = EVENTS_TOPIC,
                      starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                      streaming: bool = True, min_partitions: int | None = None,
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1: raw event records from a topic (parse them with ``parse_events``)."""
    options = kafka_source_options(bootstrap_servers, topic, starting_offsets, fail_on_data_loss,
                                   min_partitions, max_offsets_per_trigger if streaming else None)
    return read_kafka(spark, options, streaming)


def read_alerts_kafka(spark: SparkSession, bootstrap_servers: str, topic: str = ALERTS_TOPIC,
                      starting_offsets: str = "latest", streaming: bool = True) -> DataFrame:
    """S2: alert messages from a topic, decoded to the alert schema."""
    return decode_alerts(read_kafka(spark, kafka_source_options(bootstrap_servers, topic,
                                                                starting_offsets), streaming))
