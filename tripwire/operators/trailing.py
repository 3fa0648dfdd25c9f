"""Trailing-range alerts (A5-A7): the rules over one range that ends at
``as_of`` (the dashboard's "last N minutes"), not over hopping windows.

* A5 login_failed per (ip, user) >= ``trailing_failed_logins``
* A6 transaction_success per (user, ip): count >= ``trailing_transaction_velocity``
  or summed amount >= ``trailing_transaction_amount``; total rounded to cents
* A7 page_view/product_click per ip only >= ``trailing_clicks_per_ip``, reported
  under the constant user ``automated_client``

Window bounds are ``as_of - trailing_minutes`` and ``as_of``; the detection
stamp is ``as_of``. The range has no upper bound unless ``upper=True`` (then
events after ``as_of`` are left out too).

Plan: one scan and one aggregation with two grouping sets, (user, ip) for
A5/A6 and (ip) for A7, then one generator that emits the matched rules. One
shuffle in all; a hot IP is collapsed by the map-side partial aggregate. (A
union of per-rule branches would not share its aggregate: column pruning makes
each branch's aggregate different, so each would scan and shuffle again.)
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.operators.rules import MEASURES, RULE_ACTIONS, rule_measures
from tripwire.schemas import (
    AUTOMATED_CLIENT,
    BOT_BURST,
    BRUTE_FORCE,
    SEVERITY,
    TRAILING_DETAILS,
    VELOCITY,
    Rules,
)


def _as_of(events: DataFrame, as_of: datetime | str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def latest_event_time(events: DataFrame) -> Column:
    """The latest event time, as a scalar subquery: one value, computed by a job of its own over ``events``."""
    return events.select(F.max("event_time")).scalar()


def trailing_alerts(events: DataFrame, rules: Rules = Rules(), as_of=None, upper: bool = False) -> DataFrame:
    """A5-A7 over events with ``event_time`` in ``[as_of - minutes, as_of]``.

    ``as_of`` defaults to the clock, so one event dated in the future can't
    move the range; an explicit value becomes a literal filter that reaches the
    scan, and a Column (say, :func:`latest_event_time`) is used as it is. Batch only: on a stream
    ``tripwire.streaming.TrailingStore`` keeps the range.
    """
    if events.isStreaming:
        raise ValueError("trailing_alerts reads a bounded range; on a stream use streaming.TrailingStore")
    minutes = rules.trailing_minutes
    end = _as_of(events, as_of)
    start = end - F.make_interval(mins=F.lit(minutes))
    in_range = F.col("event_time") >= start
    if upper:
        in_range = in_range & (F.col("event_time") <= end)
    if "event_date" in events.columns:
        # Events at rest partitioned by date (write_events(by_date=True)): bound the
        # partition column too, so only the range's date folders are listed and read.
        in_range = in_range & (F.col("event_date") >= F.to_date(start))
    measures = rule_measures()
    levels = by_pair_and_ip(events.filter(in_range & F.col("action").isin(*RULE_ACTIONS)), measures)
    return alerts_of_levels(levels, rules, start, end)


def by_pair_and_ip(rows: DataFrame, measures: list[Column]) -> DataFrame:
    """The measures of each (user, ip) and of each ip, from one grouping."""
    return rows.groupingSets([["user_id", "ip_address"], ["ip_address"]], "user_id", "ip_address").agg(
        F.grouping("user_id").alias("per_ip"), *measures)  # per_ip is 1 on the (ip) grouping set


def alerts_of_levels(levels: DataFrame, rules: Rules, start: Column, end: Column) -> DataFrame:
    """A5-A7 from the measures of :func:`by_pair_and_ip` over the range from ``start`` to ``end``."""
    minutes = rules.trailing_minutes
    levels = levels.withColumn("txn_amount", F.coalesce("txn_amount", F.lit(0.0)))
    pair, per_ip = F.col("per_ip") == 0, F.col("per_ip") == 1
    n_login, n_txn, amount, n_click = (F.col(c) for c in MEASURES)
    candidates = [
        (BRUTE_FORCE, pair & (n_login > 0) & (n_login >= rules.trailing_failed_logins),
         F.col("user_id"), n_login, F.lit(0.0),
         F.format_string(TRAILING_DETAILS[BRUTE_FORCE], n_login, F.lit(minutes))),
        (VELOCITY, pair & (n_txn > 0) & ((n_txn >= rules.trailing_transaction_velocity)
                                         | (amount >= rules.trailing_transaction_amount)),
         F.col("user_id"), n_txn, F.round(amount, 2),
         F.format_string(TRAILING_DETAILS[VELOCITY], n_txn, F.format_number(amount, 2))),
        (BOT_BURST, per_ip & (n_click > 0) & (n_click >= rules.trailing_clicks_per_ip),
         F.lit(AUTOMATED_CLIENT), n_click, F.lit(0.0),
         F.format_string(TRAILING_DETAILS[BOT_BURST], n_click)),
    ]
    slots = F.array(*[
        F.when(cond, F.struct(
            user.cast("string").alias("user_id"),
            F.lit(kind).alias("anomaly_type"),
            F.lit(SEVERITY[kind]).alias("severity"),
            F.least(count, F.lit(2**31 - 1)).cast("int").alias("event_count"),  # the record holds an INT
            total.cast("double").alias("total_amount"),
            details.alias("details"),
        ))
        for kind, cond, user, count, total, details in candidates
    ])
    return levels.select("ip_address", F.explode(slots).alias("a")).filter(F.col("a").isNotNull()).select(
        start.alias("window_start"),
        end.alias("window_end"),
        "a.user_id",
        "ip_address",
        "a.anomaly_type",
        "a.severity",
        "a.event_count",
        "a.total_amount",
        "a.details",
        end.alias("detection_timestamp"),
    )
