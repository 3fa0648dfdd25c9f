"""Alert set maintenance: first-wins dedup (D1), latest version (D2), newest
alerts (L1/L3) and newest events (L2).

Dedup and latest are aggregations (``min_by``/``max_by`` over a struct), not a
ranking window: the partial aggregate runs map-side, so a key with millions of
versions never lands whole in one task.

Top-N reads use :func:`top_n`. ``orderBy().limit(n)`` keeps n rows per input
partition and merges them all in one task: fine for a few thousand
partitions, not for a 100 TB scan with ~10^6 splits (10^9 rows in one task).
``top_n`` therefore ranks rows within groups of consecutive input partitions
first. Catalyst applies that rank limit map-side (a partial
WindowGroupLimit), so no task merges more than about ``max_rows_per_task`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.schemas import ALERT_BUFFER, ALERT_COLUMNS, EVENT_BUFFER, FEED_ROWS

# D1 key. The dashboard keyed on (user_id, anomaly_type, window_end) only; that
# form merges click bursts of different IPs (their user is a constant) and is
# available through ``keys``.
FIRST_KEYS = ("user_id", "ip_address", "anomaly_type", "window_end")
REFERENCE_FIRST_KEYS = ("user_id", "anomaly_type", "window_end")
# D2 key: one alert per rule, window and target.
ALERT_KEYS = ("window_start", "window_end", "user_id", "ip_address", "anomaly_type")
# The live feed's columns (L3).
FEED_COLUMNS = ("detection_timestamp", "anomaly_type", "severity", "user_id", "ip_address",
                "event_count", "total_amount", "details")


def _pick(alerts: DataFrame, keys: Sequence[str], order: Sequence[Column | str], latest: bool) -> DataFrame:
    cols = alerts.columns
    rest = [c for c in cols if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], *rest)
    value = F.struct(*rest)
    pick = F.max_by(value, ordering) if latest else F.min_by(value, ordering)
    return alerts.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*cols)


def first_alerts(alerts: DataFrame, keys: Sequence[str] = FIRST_KEYS) -> DataFrame:
    """D1: keep the first alert recorded per key (earliest ``detection_timestamp``;
    remaining columns break ties, so the result is deterministic).

    On a stream the first arrival wins (``dropDuplicatesWithinWatermark``); the
    key state expires with the input's watermark. That needs the alerts' own
    event-time column, so build them with ``detect_alerts(..., keep_window=True)``;
    it is dropped here. (A second watermark on ``window_end`` would hold the
    global watermark back: append output appears only once the watermark
    passes a window, so it could never advance.)
    """
    if alerts.isStreaming:
        if "window" not in alerts.columns:
            raise ValueError("streaming first_alerts needs detect_alerts(..., keep_window=True)")
        return alerts.dropDuplicatesWithinWatermark(list(keys)).drop("window")
    return _pick(alerts.drop("window") if "window" in alerts.columns else alerts, keys,
                 ["detection_timestamp"], latest=False)


def latest_alerts(alerts: DataFrame, keys: Sequence[str] = ALERT_KEYS) -> DataFrame:
    """D2: the latest version of each alert (update-mode output repeats a window
    each time it changes): latest ``detection_timestamp``, then highest count."""
    return _pick(alerts, keys, ["detection_timestamp", "event_count"], latest=True)


def top_n(df: DataFrame, order: Sequence[Column], n: int, max_rows_per_task: int = 1_000_000) -> DataFrame:
    """The first ``n`` rows by ``order`` (give a total order for a unique result).

    One plan at every size: the top ``n`` of each group of ``max_rows_per_task //
    n`` consecutive partitions first (two partitions at least), so that the final
    merge sees at most n rows per group.
    """
    if n <= 0:
        return df.limit(0)
    fan_in = max(2, max_rows_per_task // n)
    ranked = (
        df.withColumn("_topn_group", F.floor(F.spark_partition_id() / F.lit(fan_in)))
        .withColumn("_topn_rank", F.row_number().over(Window.partitionBy("_topn_group").orderBy(*order)))
        .filter(F.col("_topn_rank") <= n)
        .drop("_topn_group", "_topn_rank")
    )
    return ranked.orderBy(*order).limit(n)


def _alert_order() -> list[Column]:
    return [
        F.col("detection_timestamp").desc_nulls_last(),
        F.col("window_start").desc_nulls_last(),
        F.col("anomaly_type").asc_nulls_first(),
        F.col("user_id").asc_nulls_first(),
        F.col("ip_address").asc_nulls_first(),
        F.col("window_end").desc_nulls_last(),
        F.col("event_count").desc_nulls_last(),
        F.col("total_amount").desc_nulls_last(),
        F.col("severity").asc_nulls_first(),
        F.col("details").asc_nulls_first(),
    ]


def recent_alerts(alerts: DataFrame, n: int = ALERT_BUFFER, columns: Sequence[str] | None = None) -> DataFrame:
    """L1/L3: the ``n`` newest alerts, newest first, optionally only ``columns``
    (those present). Ties on the stamp are broken by all other
    alert columns, so equal rows apart the result is unique."""
    out = top_n(alerts, _alert_order(), n)
    if columns is not None:
        out = out.select(*[c for c in columns if c in alerts.columns])
    return out


def new_alerts(alerts: DataFrame, recorded: DataFrame, keys: Sequence[str] = FIRST_KEYS) -> DataFrame:
    """D1 against a log: the first alert of each key that ``recorded`` doesn't hold yet, to be appended to it.
    NULL keys are equal to each other."""
    found = first_alerts(alerts, keys).alias("found")
    known = recorded.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = [F.col(f"found.{k}").eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    return found.join(known, same, "left_anti")


def alert_feed(alerts: DataFrame, n: int = FEED_ROWS) -> DataFrame:
    """L3: the live feed, newest ``n`` alerts with the eight feed columns."""
    return recent_alerts(alerts, n, FEED_COLUMNS)


def recent_events(events: DataFrame, n: int = EVENT_BUFFER) -> DataFrame:
    """L2: the ``n`` newest events by event time (event_id breaks ties). Not applied
    implicitly before any rule."""
    return top_n(events, [F.col("event_time").desc_nulls_last(), F.col("event_id").desc_nulls_last()], n)


__all__ = ["ALERT_COLUMNS", "alert_feed", "first_alerts", "latest_alerts", "new_alerts", "recent_alerts", "recent_events",
           "top_n"]
