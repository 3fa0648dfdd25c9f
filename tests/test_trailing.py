from datetime import datetime, timedelta, timezone

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from conftest import at
from tripwire.operators import latest_event_time, trailing_alerts
from tripwire.schemas import ALERT_COLUMNS, Rules

SCHEMA = StructType([
    StructField("user_id", StringType()),
    StructField("ip_address", StringType()),
    StructField("action", StringType()),
    StructField("amount", DoubleType()),
    StructField("event_time", TimestampType()),
])


def by_type(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.anomaly_type, []).append(r)
    return out


def test_trailing_rules(spark):
    rows = [("u1", "1.1.1.1", "login_failed", 0.0, at(s)) for s in range(5)]
    rows += [("u2", "2.2.2.2", "transaction_success", a, at(10 + i))
             for i, a in enumerate((1000.004, 2000.0, 1234.5))]
    rows += [(f"u{i % 7}", "3.3.3.3", "page_view", 0.0, at(i)) for i in range(80)]
    rows += [("old", "1.1.1.1", "login_failed", 0.0, at(minutes=-30)) for _ in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = trailing_alerts(df, Rules(), as_of=at(120))
    assert list(out.columns) == list(ALERT_COLUMNS)
    got = by_type(out)
    login = got["CREDENTIAL_STUFFING_BRUTE_FORCE"]
    assert [(r.user_id, r.event_count) for r in login] == [("u1", 5)]
    assert login[0].details == "5 failed login attempts in 5-minute sliding window"
    assert login[0].window_start == datetime(2025, 11, 3, 9, 57)
    assert login[0].window_end == login[0].detection_timestamp == datetime(2025, 11, 3, 10, 2)
    txn = got["TRANSACTION_VELOCITY_SPIKE"][0]
    assert (txn.event_count, txn.total_amount) == (3, 4234.5)
    assert txn.details == "Rapid sequence: 3 transactions totaling $4,234.50"
    bot = got["BOT_SCRAPING_BURST"][0]
    assert (bot.user_id, bot.ip_address, bot.event_count) == ("automated_client", "3.3.3.3", 80)
    assert bot.details == "Volumetric spike: 80 requests within window"


def test_trailing_amount_branch_and_threshold(spark):
    rows = [("u", "i", "transaction_success", 10000.0, at(0))]
    rows += [("bot", "9.9.9.9", "product_click", 0.0, at(i)) for i in range(79)]
    got = by_type(trailing_alerts(spark.createDataFrame(rows, SCHEMA), Rules(), as_of=at(60)))
    assert [r.event_count for r in got["TRANSACTION_VELOCITY_SPIKE"]] == [1]
    assert "BOT_SCRAPING_BURST" not in got  # 79 < 80


def test_a_future_event_does_not_move_the_default_range(spark):
    now = datetime.now(timezone.utc)
    rows = [("u", "i", "login_failed", 0.0, now - timedelta(seconds=s + 1)) for s in range(6)]
    rows.append(("z", "i", "page_view", 0.0, at(minutes=10**6)))
    assert [r.user_id for r in trailing_alerts(spark.createDataFrame(rows, SCHEMA)).collect()] == ["u"]


def test_as_of_the_latest_event(spark):
    rows = [("u", "i", "login_failed", 0.0, at(s)) for s in range(5)]
    rows.append(("z", "i", "page_view", 0.0, at(minutes=4)))
    df = spark.createDataFrame(rows, SCHEMA)
    out = trailing_alerts(df, as_of=latest_event_time(df)).collect()
    assert len(out) == 1 and out[0].window_end == datetime(2025, 11, 3, 10, 4)
    assert out[0].window_end - out[0].window_start == timedelta(minutes=5)


def test_upper_bound(spark):
    rows = [("u", "i", "login_failed", 0.0, at(s)) for s in range(3)]
    rows += [("u", "i", "login_failed", 0.0, at(minutes=10)) for _ in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trailing_alerts(df, Rules(), as_of=at(30)).first().event_count == 5  # no upper bound
    assert trailing_alerts(df, Rules(), as_of=at(30), upper=True).count() == 0


def test_trailing_is_batch_only(spark, tmp_path):
    import pytest

    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        trailing_alerts(stream)
