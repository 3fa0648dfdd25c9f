from tripwire.operators.alerts import alert_feed, first_alerts, latest_alerts, new_alerts, recent_alerts, recent_events
from tripwire.operators.codec import decode_alerts, encode_alerts, encode_events, rejected_messages
from tripwire.operators.parse import (
    classify_events,
    decode_events,
    parse_events,
    rejected_events,
    split_events,
    validate_events,
)
from tripwire.operators.panes import detect_alerts_panes
from tripwire.operators.rules import (
    brute_force,
    click_burst,
    detect_alerts,
    detect_alerts_union,
    transaction_velocity,
)
from tripwire.operators.summary import alert_kpis, alerts_by_type, event_count, top_ips
from tripwire.operators.trailing import latest_event_time, trailing_alerts

__all__ = [
    "alert_feed", "alert_kpis", "alerts_by_type", "brute_force", "classify_events", "click_burst",
    "decode_alerts", "decode_events", "detect_alerts", "detect_alerts_panes", "detect_alerts_union", "encode_alerts",
    "encode_events", "event_count", "first_alerts", "latest_alerts", "latest_event_time", "new_alerts", "parse_events", "recent_alerts",
    "recent_events", "rejected_events", "rejected_messages", "split_events", "top_ips", "trailing_alerts",
    "transaction_velocity", "validate_events",
]
