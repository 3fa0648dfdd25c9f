from datetime import datetime

from tripwire.operators import alert_kpis, alerts_by_type, event_count, top_ips
from tripwire.schemas import ALERT_SCHEMA

T = datetime(2025, 11, 3, 10, 0)


def alerts(spark, specs):
    return spark.createDataFrame(
        [(T, T, "u", ip, kind, sev, 1, 0.0, "d", T) for ip, kind, sev in specs], ALERT_SCHEMA)


def test_kpis(spark):
    df = alerts(spark, [("1.1.1.1", "A", "CRITICAL"), ("1.1.1.1", "B", "HIGH"), ("", "A", "MEDIUM"),
                        (None, "A", "CRITICAL"), ("2.2.2.2", "C", "HIGH")])
    k = alert_kpis(df).first()
    assert (k.total_alerts, k.critical_alerts, k.high_alerts, k.flagged_ips) == (5, 2, 2, 2)


def test_by_type_and_top_ips(spark):
    specs = [("1.1.1.1", "A", "HIGH")] * 3 + [("2.2.2.2", "B", "HIGH")] * 3 + [("0.0.0.9", "A", "HIGH")] \
        + [(None, "A", "HIGH")] * 5 + [(f"3.3.3.{i}", "C", "HIGH") for i in range(6)]
    df = alerts(spark, specs)
    assert {r.anomaly_type: r.alert_count for r in alerts_by_type(df).collect()} == {"A": 9, "B": 3, "C": 6}
    top = [(r.ip_address, r.alert_count) for r in top_ips(df, 6).collect()]
    assert top == [("1.1.1.1", 3), ("2.2.2.2", 3), ("0.0.0.9", 1), ("3.3.3.0", 1), ("3.3.3.1", 1),
                   ("3.3.3.2", 1)]


def test_event_count(spark):
    assert event_count(spark.range(42)).first().total_events == 42
