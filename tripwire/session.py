"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder every lineage cut and streaming checkpoint goes under."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings this engine relies on. Event times carry explicit offsets, but
# window bounds are rendered (JSON, timestamp_ntz) in the session zone.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tripwire") -> SparkSession:
    """Local session for tests and benches (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (window bounds and JSON text depend on it)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system path). Only a local
    session without one gets a fresh temporary folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    # spark.checkpoint.dir is a core (startup) setting; at run time the
    # context's checkpoint folder is the one to set.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripwire-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for one run of ``name``."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
