"""Batch-committed tables: what a ``foreachBatch`` sink keeps between micro-batches.

A streaming query replays a micro-batch under the same id after a failure. The
sinks built on :class:`BatchStore` therefore write only folders that carry the
batch's id, overwrite them, read only what earlier batches wrote, and write a
small commit record last. A replayed batch that was committed is skipped; one
that was not repeats its writes. So every batch counts once, whatever died.

Everything lies under one path on the shared file system and is written and
read by Spark. Old folders are listed and dropped through Hadoop's file system
API, as no DataFrame operation does that.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripwire.streaming.sinks import DEFAULT_TRIGGER, state_partitions_for_start


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files directly under ``path`` (none if it is absent)."""
    fs, jpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def drop(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def values(spark: SparkSession, path: str, name: str) -> list[int]:
    """The whole numbers v of the folders ``name=v`` under ``path``."""
    found = (re.fullmatch(rf"{name}=(-?\d+)", child) for child in children(spark, path))
    return sorted(int(m[1]) for m in found if m)


def read_parts(spark: SparkSession, path: str, name: str, wanted: Sequence[int], schema) -> DataFrame:
    """The folders ``name=v`` of ``wanted`` only (others aren't listed), with their partition columns."""
    paths = [f"{path}/{name}={v}" for v in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


class BatchStore:
    """A ``foreachBatch`` sink with a commit record per batch; subclasses write in :meth:`apply`."""

    output_mode = "append"
    #: Commit records (and what else carries a batch id) kept behind the newest, for readers that are still at them.
    keep_batches = 100

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    # -- to be given by subclasses

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        """Write the batch; ``before`` is what the batch before returned. The result is the commit record."""
        raise NotImplementedError

    # -- commits

    def commit(self, spark: SparkSession, batch_id: int) -> dict | None:
        """The record of a batch, or None if it is not committed."""
        path = f"{self.path}/commits/batch_id={batch_id}"
        return json.loads(spark.read.text(path).first()[0]) if exists(spark, f"{path}/_SUCCESS") else None

    def last_batch(self, spark: SparkSession) -> int | None:
        done = [n for n in values(spark, f"{self.path}/commits", "batch_id") if exists(spark, f"{self.path}/commits/batch_id={n}/_SUCCESS")]
        return done[-1] if done else None

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if exists(spark, f"{self.path}/commits/batch_id={batch_id}/_SUCCESS"):
            return
        before = self.commit(spark, batch_id - 1) if batch_id else {}
        if before is None:
            raise ValueError(f"{self.path} has no commit of batch {batch_id - 1}: not the store of this checkpoint")
        record = self.apply(batch, batch_id, before)
        spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.path}/commits/batch_id={batch_id}")
        drop(spark, f"{self.path}/commits/batch_id={batch_id - self.keep_batches}")

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None, query_name: str | None = None,
              state_partitions: int | None = None) -> StreamingQuery:
        writer = (stream.writeStream.outputMode(self.output_mode).foreachBatch(self.handle)
                  .option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER)))
        if query_name:
            writer = writer.queryName(query_name)
        with state_partitions_for_start(stream.sparkSession, state_partitions):
            return writer.start()

    # -- tables by batch

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{table}/batch_id={batch_id}")

    def write_slots(self, df: DataFrame, table: str, slot: str, batch_id: int) -> None:
        """Rows by the slot column and, below, by batch: only the batch's own folders are replaced."""
        from pyspark.sql import functions as F

        (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").partitionBy(slot, "batch_id")
         .option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{table}"))
