"""Message encoding (P10, P11) and alert decoding (S2): rows <-> (key, JSON value).

``to_json`` drops NULL fields and renders timestamps in the session zone as
``2026-08-20T10:00:00.000Z`` under UTC; ``from_json`` reads them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.schemas import ALERT_COLUMNS, ALERT_SCHEMA, EVENT_FIELDS


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts -> ``(key = user_id, value = JSON of the 10 alert fields)``."""
    return alerts.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*ALERT_COLUMNS)).alias("value"),
    )


# An alert always has these; a message without one of them is no alert.
REQUIRED = ("window_start", "window_end", "anomaly_type", "severity", "event_count")


def _is_alert() -> Column:
    return F.forall(F.array(*[F.col(c).isNotNull() for c in REQUIRED]), lambda ok: ok)


def decode_alerts(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Alert messages -> the 10 alert columns (flattened by a generator, so later
    filters do not re-parse the JSON; see ``tripwire.operators.parse``). Messages
    that are no alert are left out; ``rejected_messages`` has them."""
    decoded = messages.select(F.inline(F.array(F.from_json(F.col(value_col).cast("string"), ALERT_SCHEMA))))
    return decoded.filter(_is_alert())


def rejected_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """The messages that ``decode_alerts`` leaves out, as they came."""
    decoded = messages.withColumn("_alert", F.from_json(F.col(value_col).cast("string"), ALERT_SCHEMA))
    bad = F.col("_alert").isNull() | F.exists(F.array(*[F.col(f"_alert.{c}").isNull() for c in REQUIRED]), lambda b: b)
    return decoded.filter(bad).drop("_alert")


def encode_events(events: DataFrame) -> DataFrame:
    """Events -> ``(key = user_id, value = JSON payload)``; the key keeps a
    user's events in one Kafka partition, hence in order."""
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*[n for n, _, _ in EVENT_FIELDS])).alias("value"),
    )
