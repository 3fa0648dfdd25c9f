"""Read back event and alert datasets written by the sinks (S3).

Schemas are given explicitly: no inference pass over the files, and the
``action`` partition column keeps its string type. A filter on ``action``
prunes partition directories; other filters and the column list reach the
Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tripwire.schemas import ALERT_SCHEMA, PARSED_EVENT_SCHEMA, VALID


def _nullable(schema: StructType) -> StructType:
    return StructType([f.__class__(f.name, f.dataType, True) for f in schema.fields])


def _reader(spark: SparkSession, streaming: bool, max_files_per_trigger: int | None):
    if not streaming:
        return spark.read
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader


def read_events(spark: SparkSession, path: str, streaming: bool = False, by_date: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Events written by ``write_events``; ``by_date`` for the (action, event_date) layout.

    As a stream (``streaming=True``) with an ``availableNow`` trigger this is an
    incremental backfill: each run processes only files not yet seen, in
    micro-batches of at most ``max_files_per_trigger`` files, and its
    checkpoint records the progress.
    """
    schema = PARSED_EVENT_SCHEMA
    if by_date:
        schema = StructType(schema.fields + [StructField("event_date", DateType(), True)])
    return _reader(spark, streaming, max_files_per_trigger).schema(schema).parquet(path)


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` of a folder written by ``write_split``; each reads its own outcome folders only."""
    schema = StructType([StructField("payload", StringType()), *PARSED_EVENT_SCHEMA.fields, StructField("outcome", StringType())])
    rows = spark.read.schema(schema).parquet(path)
    valid = rows.filter(F.col("outcome") == VALID).drop("payload", "outcome")
    return valid, rows.filter(F.col("outcome") != VALID).withColumnRenamed("outcome", "reject_reason")


def read_alerts(spark: SparkSession, path: str, streaming: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    return _reader(spark, streaming, max_files_per_trigger).schema(_nullable(ALERT_SCHEMA)).parquet(path)


def read_alert_updates(spark: SparkSession, path: str) -> DataFrame:
    """The update log written by ``write_alert_updates``, with its ``batch_id``."""
    schema = StructType(_nullable(ALERT_SCHEMA).fields + [StructField("batch_id", LongType(), True)])
    return spark.read.schema(schema).parquet(path)
