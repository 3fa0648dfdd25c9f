"""The pane plan gives the rows of the union of the three rules, from one exchange."""

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tripwire.operators import detect_alerts, detect_alerts_panes, detect_alerts_union
from tripwire.operators.panes import MAX_PANES, interval_micros
from tripwire.plans.driver import DRIVER_RULES, events as driver_events
from tripwire.schemas import CLICK_ACTIONS, LOGIN_FAILED, TRANSACTION_SUCCESS, Rules

ACTIONS = [LOGIN_FAILED, TRANSACTION_SUCCESS, *CLICK_ACTIONS, "logout", None]
SCHEMA = "user_id string, ip_address string, action string, amount double, event_time timestamp"
COLUMNS = ("window_start", "window_end", "user_id", "ip_address", "anomaly_type", "severity", "event_count", "total_amount", "details")


def some_events(n, start, seed=7, users=5, hot=0.4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = "hot" if rng.random() < hot else rng.choice([f"u{rng.randrange(users)}", None])
        amount = rng.choice([None, float("nan"), 0.0, 12.5, 400.25, -3.5])
        at = start + timedelta(microseconds=rng.randrange(25 * 60 * 10**6))
        rows.append((user, rng.choice(["i", "j", None]), rng.choice(ACTIONS), amount, at))
    for minute in range(6):  # exactly on window and pane edges
        rows += [("edge", "i", LOGIN_FAILED, 0.0, start + timedelta(minutes=minute))] * 2
    rows.append(("x", "y", LOGIN_FAILED, 0.0, None))
    return rows


def rows_of(df):
    return sorted((tuple(None if r[c] is None else str(round(r[c], 6) if isinstance(r[c], float) else r[c]) for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("window, slide", [
    ("5 minutes", "1 minute"), ("1 minute", "1 minute"), ("6 minutes", "1 minute"), ("7 minutes", "1 minute"),
    ("2 minutes", "1 minute"), ("5 minutes", "2 minutes"), ("7 minutes", "3 minutes"), ("90 seconds", "60 seconds"), ("20 minutes", "30 seconds"),
])
@pytest.mark.parametrize("year", [1969, 2025])
def test_equals_the_union(spark, window, slide, year):
    start = datetime(year, 12, 31, 23, 48, 30, tzinfo=timezone.utc)
    frame = spark.createDataFrame(some_events(500, start), SCHEMA)
    rules = Rules(window=window, slide=slide, max_failed_logins=2, max_transaction_velocity=3, max_transaction_amount=900.0, max_clicks_per_window=3)
    got = rows_of(detect_alerts_panes(frame, rules))
    assert got == rows_of(detect_alerts_union(frame, rules))
    assert got


@pytest.mark.parametrize("keys", [("user_id",), ("ip_address",)])
def test_fewer_keys(spark, keys):
    frame = spark.createDataFrame(some_events(300, datetime(2025, 2, 3, 4, 5, tzinfo=timezone.utc)), SCHEMA)
    rules = Rules(max_failed_logins=4, max_transaction_velocity=5, max_clicks_per_window=7)
    assert rows_of(detect_alerts_panes(frame, rules, keys)) == rows_of(detect_alerts(frame, rules, keys))


def test_thresholds_of_zero_and_empty_input(spark):
    frame = spark.createDataFrame(some_events(60, datetime(2025, 2, 3, tzinfo=timezone.utc)), SCHEMA)
    rules = Rules(max_failed_logins=0, max_transaction_velocity=0, max_transaction_amount=0.0, max_clicks_per_window=0)
    assert rows_of(detect_alerts_panes(frame, rules)) == rows_of(detect_alerts_union(frame, rules))
    assert detect_alerts_panes(frame.limit(0), rules).count() == 0


def test_refused(spark):
    frame = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        detect_alerts_panes(frame, Rules(), keys=())
    with pytest.raises(ValueError):
        detect_alerts_panes(frame, Rules(window="1 minute", slide="2 minutes"))
    with pytest.raises(ValueError):
        detect_alerts_panes(spark.readStream.format("rate").load().select(F.lit("u").alias("user_id")), Rules())


def test_intervals():
    assert interval_micros("5 minutes") == 300_000_000
    assert interval_micros("1 day 2 hours 250 milliseconds") == 93_600_250_000
    assert interval_micros(" INTERVAL 1  week") == 604_800_000_000
    for wrong in ("", "5", "minutes", "1 month", "5 minutes x", "1.5 hours", "-1 day"):
        with pytest.raises(ValueError):
            interval_micros(wrong)


@pytest.mark.parametrize("window, exchanges", [("5 days", 1), (f"{MAX_PANES} days", 1), (f"{MAX_PANES + 1} days", 2)])
def test_one_exchange_of_less_rows_than_events(spark, window, exchanges):
    rules = DRIVER_RULES.with_(window=window)
    every = driver_events(spark, "/root/testdata/sf0.01")
    text = detect_alerts_panes(every, rules)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", text)) == exchanges
    assert "partial_sum" in text


def test_shuffled_rows_are_below_the_rule_events(spark):
    """The rows of the one exchange: a row for each key and block of a task."""
    every = driver_events(spark, "/root/testdata/sf0.01").cache()
    n = every.filter(F.col("action").isin(LOGIN_FAILED, TRANSACTION_SUCCESS, *CLICK_ACTIONS)).count()

    def shuffled(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        total, todo = 0, [plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan]
        while todo:
            node = todo.pop()
            if node.nodeName().startswith(("ShuffleQueryStage", "ResultQueryStage")):
                todo.append(node.plan())
                continue
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return total

    panes, direct = shuffled(detect_alerts_panes(every, DRIVER_RULES)), shuffled(detect_alerts(every, DRIVER_RULES))
    every.unpersist()
    assert 0 < panes < n < direct
