"""Replay a table as a stream of several runs: each slice is added to a source folder, and the queries run once over it."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripwire.streaming.job import run_once, watermark_report


def replay(spark: SparkSession, slices: Iterable[DataFrame], source: str,
           start: Callable[[DataFrame], StreamingQuery | list[StreamingQuery]]) -> list[list[dict]]:
    """For every slice: append it to the Parquet folder ``source``, hand the folder as a stream to ``start``, and wait for
    the (run-once) queries that it starts. Their checkpoints carry state and progress from run to run. Returns the
    micro-batches of each run (see ``watermark_report``)."""
    reports = []
    for part in slices:
        part.write.mode("append").parquet(source)
        queries = start(spark.readStream.schema(part.schema).parquet(source))
        queries = queries if isinstance(queries, list) else [queries]
        for query in queries:
            run_once(query)
        reports.append([batch for query in queries for batch in watermark_report(query)])
    return reports
