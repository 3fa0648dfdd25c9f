"""Connected components by union-find in each partition and alternating star contraction between partitions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.llm._tables import merged, stored


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's edges; each node with its root (the least node it met)."""
    parent: dict = {}
    kind = None

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 10_000):
        part = nodes[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)], names=["u", "v"])


def _large_star(e: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node of its neighbourhood."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return merged(both.where("v > u"), least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them. Edges run from the larger node u to v."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    tied = merged(e, least, "u")
    return tied.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (two columns of one type) that is not the least of its component.

    Edges never reach the driver; it sees two numbers a round. The rounds end
    when contraction changes nothing, after a number of rounds that grows with
    the logarithm of the longest chain.
    """
    a, b = edges.columns
    kind = edges.schema[a].dataType.simpleString()
    e = edges.select(a, b).where(F.col(a) != F.col(b)).mapInArrow(_forest, f"u {kind}, v {kind}")
    e = stored(e.distinct(), "forest")
    before = None
    while True:
        e = stored(_small_star(_large_star(e)), "stars")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
