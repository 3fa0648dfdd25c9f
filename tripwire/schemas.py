"""Fixed schemas of the event and alert records, and the rule parameters."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The event payload fields, in payload order. The flag is the
# non-null flag of the declared Spark schema (the "core" validation level).
EVENT_FIELDS = (
    ("event_id", StringType(), False),
    ("timestamp", StringType(), False),
    ("user_id", StringType(), False),
    ("session_id", StringType(), False),
    ("ip_address", StringType(), False),
    ("device_type", StringType(), True),
    ("location_country", StringType(), True),
    ("location_city", StringType(), True),
    ("action", StringType(), False),
    ("url_path", StringType(), True),
    ("amount", DoubleType(), True),
    ("user_agent", StringType(), True),
)

EVENT_SCHEMA = StructType([StructField(n, t, nullable) for n, t, nullable in EVENT_FIELDS])

# Parsed events carry the payload fields plus the derived event time.
PARSED_EVENT_SCHEMA = StructType(
    [StructField(n, t, True) for n, t, _ in EVENT_FIELDS]
    + [StructField("event_time", TimestampType(), True)]
)

# Validation levels. "core" is the set of non-null fields of the
# Spark schema; "strict" is every field the record model requires (all but amount).
CORE_FIELDS = tuple(n for n, _, nullable in EVENT_FIELDS if not nullable)
STRICT_FIELDS = tuple(n for n, _, _ in EVENT_FIELDS if n != "amount")

# The alert record, in output order.
ALERT_FIELDS = (
    ("window_start", TimestampType(), False),
    ("window_end", TimestampType(), False),
    ("user_id", StringType(), True),
    ("ip_address", StringType(), True),
    ("anomaly_type", StringType(), False),
    ("severity", StringType(), False),
    ("event_count", IntegerType(), False),
    ("total_amount", DoubleType(), True),
    ("details", StringType(), True),
    ("detection_timestamp", TimestampType(), False),
)

ALERT_SCHEMA = StructType([StructField(n, t, nullable) for n, t, nullable in ALERT_FIELDS])
ALERT_COLUMNS = tuple(n for n, _, _ in ALERT_FIELDS)

# Action names read by the rules.
LOGIN_FAILED = "login_failed"
TRANSACTION_SUCCESS = "transaction_success"
CLICK_ACTIONS = ("page_view", "product_click")

# Alert types, severities and fixed details texts.
BRUTE_FORCE = "CREDENTIAL_STUFFING_BRUTE_FORCE"
VELOCITY = "TRANSACTION_VELOCITY_SPIKE"
BOT_BURST = "BOT_SCRAPING_BURST"
SEVERITY = {BRUTE_FORCE: "HIGH", VELOCITY: "CRITICAL", BOT_BURST: "MEDIUM"}
DETAILS = {
    BRUTE_FORCE: "Multiple failed login attempts exceeding security threshold",
    VELOCITY: "High volume or high cumulative transaction amount in window",
    BOT_BURST: "Rapid clickstream request frequency matching bot signature",
}
# The trailing (dashboard) rules' constant user and details texts
# (printf-style: count, then window minutes or the amount with thousands separators).
AUTOMATED_CLIENT = "automated_client"
TRAILING_DETAILS = {
    BRUTE_FORCE: "%d failed login attempts in %d-minute sliding window",
    VELOCITY: "Rapid sequence: %d transactions totaling $%s",
    BOT_BURST: "Volumetric spike: %d requests within window",
}
# Severities counted by the KPI cards.
KPI_SEVERITIES = ("CRITICAL", "HIGH")
# Topics, micro-batch trigger, and dashboard sizes (alert buffer,
# event buffer, feed rows, top IPs).
EVENTS_TOPIC = "events.raw"
ALERTS_TOPIC = "events.anomalies"
TRIGGER_INTERVAL = "5 seconds"
ALERT_BUFFER = 200
EVENT_BUFFER = 1000
FEED_ROWS = 30
TOP_IPS = 6


# Outcome of a payload that no reject reason applies to.
VALID = "valid"


@dataclass(frozen=True)
class Rules:
    """Window sizes and thresholds. Defaults (fixed values) are the reference configuration.

    Thresholds are inclusive (``>=``). ``window``/``slide``/``watermark`` are
    Spark interval strings; slide equal to window gives tumbling windows.
    The ``trailing_*`` fields drive :func:`tripwire.operators.trailing.trailing_alerts`.
    """

    window: str = "5 minutes"
    slide: str = "1 minute"
    watermark: str = "10 minutes"
    max_failed_logins: int = 5
    max_transaction_velocity: int = 3
    max_transaction_amount: float = 10000.0
    max_clicks_per_window: int = 100
    trailing_minutes: int = 5
    trailing_failed_logins: int = 5
    trailing_transaction_velocity: int = 3
    trailing_transaction_amount: float = 10000.0
    trailing_clicks_per_ip: int = 80

    def with_(self, **changes) -> "Rules":
        return replace(self, **changes)

    @classmethod
    def from_config(cls, config: dict) -> "Rules":
        """Rules from the reference's configuration layout (a parsed YAML/JSON
        dict): ``streaming.{watermark,window,slide}_duration`` and
        ``streaming.rules.max_*``. Keys that are absent keep the defaults."""
        streaming = (config or {}).get("streaming", {}) or {}
        thresholds = streaming.get("rules", {}) or {}
        # The reference's configuration keys -> Rules fields.
        durations = {"watermark_duration": "watermark", "window_duration": "window", "slide_duration": "slide"}
        limits = ("max_failed_logins", "max_transaction_velocity", "max_transaction_amount",
                  "max_clicks_per_window")
        changes = {field: streaming[key] for key, field in durations.items() if key in streaming}
        changes.update({key: thresholds[key] for key in limits if key in thresholds})
        return cls().with_(**changes)
