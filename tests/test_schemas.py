from tripwire.schemas import ALERT_SCHEMA, CORE_FIELDS, EVENT_SCHEMA, STRICT_FIELDS, Rules


def test_schema_sizes():
    assert len(EVENT_SCHEMA.fields) == 12
    assert len(ALERT_SCHEMA.fields) == 10
    assert {"event_id", "timestamp", "user_id", "action", "amount"} <= set(EVENT_SCHEMA.fieldNames())
    assert {"window_start", "window_end", "anomaly_type", "severity", "detection_timestamp"} <= set(
        ALERT_SCHEMA.fieldNames())


def test_validation_levels():
    assert CORE_FIELDS == ("event_id", "timestamp", "user_id", "session_id", "ip_address", "action")
    assert "amount" not in STRICT_FIELDS and len(STRICT_FIELDS) == 11


def test_rule_defaults():
    r = Rules()
    assert (r.window, r.slide, r.watermark) == ("5 minutes", "1 minute", "10 minutes")
    assert (r.max_failed_logins, r.max_transaction_velocity, r.max_transaction_amount,
            r.max_clicks_per_window) == (5, 3, 10000.0, 100)
    assert (r.trailing_minutes, r.trailing_clicks_per_ip) == (5, 80)
    assert r.with_(max_failed_logins=3).max_failed_logins == 3


def test_rules_from_reference_config():
    config = {"streaming": {"watermark_duration": "2 minutes", "window_duration": "10 minutes",
                            "rules": {"max_failed_logins": 3, "max_transaction_amount": 5000.0}}}
    r = Rules.from_config(config)
    assert (r.watermark, r.window, r.slide) == ("2 minutes", "10 minutes", "1 minute")
    assert (r.max_failed_logins, r.max_transaction_amount, r.max_clicks_per_window) == (3, 5000.0, 100)
    assert Rules.from_config({}) == Rules()
