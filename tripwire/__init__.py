"""tripwire: event-stream alerting on Spark DataFrames (batch and Structured Streaming)."""

from tripwire.schemas import ALERT_SCHEMA, EVENT_SCHEMA, Rules

__all__ = ["ALERT_SCHEMA", "EVENT_SCHEMA", "Rules"]
