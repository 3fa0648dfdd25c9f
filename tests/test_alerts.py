from datetime import datetime, timedelta

from tripwire.operators import alert_feed, first_alerts, latest_alerts, recent_alerts, recent_events
from tripwire.operators.alerts import FEED_COLUMNS, REFERENCE_FIRST_KEYS
from tripwire.schemas import ALERT_SCHEMA

T = datetime(2025, 11, 3, 10, 0)


def alert(rows, spark):
    return spark.createDataFrame(rows, ALERT_SCHEMA)


def row(user, ip, kind, count, stamp_min, end_min=5, total=0.0):
    return (T, T + timedelta(minutes=end_min), user, ip, kind, "HIGH", count, total, "d",
            T + timedelta(minutes=stamp_min))


def test_first_alerts_reference_key_keeps_first(spark):
    rows = [row("automated_client", "9.9.9.9", "BOT_SCRAPING_BURST", 90, 2),
            row("automated_client", "1.1.1.1", "BOT_SCRAPING_BURST", 85, 1),
            row("automated_client", "5.5.5.5", "BOT_SCRAPING_BURST", 99, 1)]
    df = alert(rows, spark)
    ref = first_alerts(df, REFERENCE_FIRST_KEYS).collect()
    assert [(r.ip_address, r.event_count) for r in ref] == [("1.1.1.1", 85)]  # earliest, then lowest ip
    assert first_alerts(df).count() == 3  # default key includes the IP
    assert first_alerts(df).columns == df.columns


def test_latest_alerts(spark):
    rows = [row("u", "i", "X", 5, 1), row("u", "i", "X", 7, 3), row("u", "i", "X", 6, 2),
            row("v", "i", "X", 1, 1)]
    out = sorted((r.user_id, r.event_count) for r in latest_alerts(alert(rows, spark)).collect())
    assert out == [("u", 7), ("v", 1)]


def test_recent_alerts_order_and_columns(spark):
    rows = [row(f"u{i}", "i", "X", i, i) for i in range(10)]
    out = recent_alerts(alert(rows, spark), 3).collect()
    assert [r.user_id for r in out] == ["u9", "u8", "u7"]
    feed = alert_feed(alert(rows, spark), 2)
    assert tuple(feed.columns) == FEED_COLUMNS and feed.count() == 2


def test_recent_events(spark):
    df = spark.createDataFrame([(str(i), T + timedelta(seconds=i)) for i in range(20)],
                               "event_id string, event_time timestamp")
    assert [r.event_id for r in recent_events(df, 3).collect()] == ["19", "18", "17"]


def test_top_n_two_level_equals_plain(spark):
    from pyspark.sql import functions as F

    from tripwire.operators.alerts import top_n

    df = spark.range(0, 50000, numPartitions=20).withColumn("k", (F.col("id") * 7919) % 10007)
    order = [F.col("k").desc(), F.col("id").asc()]
    plain = df.orderBy(*order).limit(50)
    for most in (40, 1_000_000):  # the same plan however many partitions a group has
        two = top_n(df, order, 50, max_rows_per_task=most)
        assert [tuple(r) for r in two.collect()] == [tuple(r) for r in plain.collect()]
        text = two._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in text and "Partial" in text  # ranked map-side before the shuffle


def test_new_alerts_leaves_out_recorded_keys(spark):
    from tripwire.operators import new_alerts

    rows = [("u1", "k", 1, 5), ("u1", "k", 2, 6), ("u2", "k", 1, 7), (None, "k", 1, 8)]
    alerts = spark.createDataFrame(rows, "user_id string, anomaly_type string, event_count int, detection_timestamp int")
    keys = ("user_id", "anomaly_type")
    assert {r.user_id: r.detection_timestamp for r in new_alerts(alerts, alerts.limit(0), keys).collect()} == {"u1": 5, "u2": 7, None: 8}
    assert [r.user_id for r in new_alerts(alerts, alerts.filter("user_id = 'u1' or user_id is null"), keys).collect()] == ["u2"]


def test_totals_are_wide(spark):
    from tripwire.operators import event_count

    assert event_count(spark.range(2_200_000_000)).first()[0] == 2_200_000_000
