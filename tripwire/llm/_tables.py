"""Tables written between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from tripwire.session import scratch_path
from tripwire.sources.tables import table_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again: its lineage ends there,
    so a lost executor costs no more than the step it was working on."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``stored``, in Spark's buckets of ``key``: rows are joined or grouped by it without an exchange."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"tripwire_{uuid.uuid4().hex}"
    df.write.bucketBy(partitions(spark), key).option("path", path).format("parquet").saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolved: the files are read from here on, the name isn't needed
    spark.sql(f"DROP TABLE {table}")  # of a table with a path, the files stay
    return out


def merged(left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner") -> DataFrame:
    """``left.join(right, on, how)`` by a sort-merge join. For sides that both grow with the input: Spark judges a side by
    its compressed files and by one element of an array, and one that it takes for small goes through the driver whole."""
    return left.join(right.hint("merge"), on, how)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
