"""Dashboard summaries over an alert set (A8-A10) and the event total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.operators.alerts import top_n
from tripwire.schemas import KPI_SEVERITIES, TOP_IPS


def alert_kpis(alerts: DataFrame) -> DataFrame:
    """A8: one row: total alerts, CRITICAL and HIGH counts, distinct non-empty IPs.

    The dashboard showed these over its newest 200 alerts: pass
    ``recent_alerts(alerts, 200)`` for that view.
    """
    ip = F.col("ip_address")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        *[F.count_if(F.col("severity") == sev).alias(f"{sev.lower()}_alerts") for sev in KPI_SEVERITIES],
        F.count_distinct(F.when(ip != "", ip)).alias("flagged_ips"),
    )


def event_count(events: DataFrame) -> DataFrame:
    """A8: total ingested events."""
    return events.agg(F.count(F.lit(1)).alias("total_events"))


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    """A9: alerts per anomaly type (NULL types skipped)."""
    return (
        alerts.filter(F.col("anomaly_type").isNotNull())
        .groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )


def top_ips(alerts: DataFrame, n: int = TOP_IPS) -> DataFrame:
    """A10: the ``n`` IPs with most alerts (ties: lower IP first; NULL skipped)."""
    counts = (
        alerts.filter(F.col("ip_address").isNotNull())
        .groupBy("ip_address")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )
    return top_n(counts, [F.col("alert_count").desc(), F.col("ip_address").asc()], n)
