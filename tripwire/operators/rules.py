"""Sliding-window alert rules (A1-A3), their fused form (A4) and union (U1).

Every rule groups events by (hopping event-time window, user_id, ip_address)
and tests inclusive thresholds. Each works on batch and streaming frames; on a
stream with a watermark the window state is evicted once the watermark passes
the window end.

Plan shape: Filter -> Expand (one row per window an event falls in) -> partial
HashAggregate -> Exchange on (window, keys) -> final HashAggregate. The partial
aggregate runs map-side, so a hot user or IP is collapsed to one row per
(window, key) per input partition before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.functions import nan_to_null, watermark_safe
from tripwire.schemas import (
    BOT_BURST,
    BRUTE_FORCE,
    CLICK_ACTIONS,
    DETAILS,
    LOGIN_FAILED,
    SEVERITY,
    TRANSACTION_SUCCESS,
    VELOCITY,
    Rules,
)

DEFAULT_KEYS = ("user_id", "ip_address")
RULE_ACTIONS = (LOGIN_FAILED, TRANSACTION_SUCCESS, *CLICK_ACTIONS)
MEASURES = ("n_login", "n_txn", "txn_amount", "n_click")


def check_keys(keys: Sequence[str]) -> None:
    if not keys or not set(keys) <= set(DEFAULT_KEYS):
        # The alert record carries user_id and ip_address only.
        raise ValueError(f"keys must be a non-empty subset of {DEFAULT_KEYS}, got {tuple(keys)}")


def _grouped(events: DataFrame, cond: Column, rules: Rules, keys: Sequence[str]):
    check_keys(keys)
    return events.filter(watermark_safe(events, cond)).groupBy(
        F.window("event_time", rules.window, rules.slide).alias("window"), *keys
    )


def _key_cols(keys: Sequence[str]) -> list[Column]:
    # A rule keyed by fewer columns (e.g. per user only) reports the others as NULL.
    return [F.col(k) if k in keys else F.lit(None).cast("string").alias(k) for k in DEFAULT_KEYS]


def _alert(kind: str, count: Column, total: Column) -> list[Column]:
    return [
        F.lit(kind).alias("anomaly_type"),
        F.lit(SEVERITY[kind]).alias("severity"),
        F.least(count, F.lit(2**31 - 1)).cast("int").alias("event_count"),  # the record holds an INT
        total.cast("double").alias("total_amount"),
        F.lit(DETAILS[kind]).alias("details"),
    ]


def _project(agg: DataFrame, keys: Sequence[str], kind: str, count: Column, total: Column) -> DataFrame:
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *_key_cols(keys),
        *_alert(kind, count, total),
        F.current_timestamp().alias("detection_timestamp"),
    )


def _event_time_col(keep_window: bool) -> list[str]:
    # The window struct is the aggregate's event-time column: a later stateful
    # step on a stream (first_alerts) needs it to share the input's watermark.
    return ["window"] if keep_window else []


def brute_force(events: DataFrame, rules: Rules = Rules(), keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """A1: at least ``max_failed_logins`` login_failed events in a window."""
    agg = (
        _grouped(events, F.col("action") == LOGIN_FAILED, rules, keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= rules.max_failed_logins)
    )
    return _project(agg, keys, BRUTE_FORCE, F.col("n"), F.lit(0.0))


def transaction_velocity(events: DataFrame, rules: Rules = Rules(),
                         keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """A2: at least ``max_transaction_velocity`` successful transactions, or a
    summed amount of at least ``max_transaction_amount``, in a window.
    NULL and NaN amounts are skipped by the sum."""
    agg = (
        _grouped(events, F.col("action") == TRANSACTION_SUCCESS, rules, keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(nan_to_null("amount")).alias("amount"))
        .filter((F.col("n") >= rules.max_transaction_velocity)
                | (F.col("amount") >= rules.max_transaction_amount))
    )
    return _project(agg, keys, VELOCITY, F.col("n"), F.col("amount"))


def click_burst(events: DataFrame, rules: Rules = Rules(), keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """A3: at least ``max_clicks_per_window`` page_view/product_click events."""
    agg = (
        _grouped(events, F.col("action").isin(*CLICK_ACTIONS), rules, keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= rules.max_clicks_per_window)
    )
    return _project(agg, keys, BOT_BURST, F.col("n"), F.lit(0.0))


def detect_alerts_union(events: DataFrame, rules: Rules = Rules(),
                        keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """U1: the three rules as separate aggregations, unioned by name.

    Three scans and three shuffles (and three state stores on a stream); kept
    as the cross-check of :func:`detect_alerts`.
    """
    return (
        brute_force(events, rules, keys)
        .unionByName(transaction_velocity(events, rules, keys))
        .unionByName(click_burst(events, rules, keys))
    )


def detect_alerts(events: DataFrame, rules: Rules = Rules(), keys: Sequence[str] = DEFAULT_KEYS,
                  keep_window: bool = False) -> DataFrame:
    """A4: all three rules from one scan, one shuffle and one aggregation.

    Per (window, keys) the conditional counts and the transaction sum are taken
    together; each matched rule then yields one alert row (0-3 per group). The
    ``n > 0`` guards keep a rule from firing on a group that has none of its
    actions (equal to the union even with thresholds <= 0).

    On a stream in update mode, a change to any rule of a group re-emits every
    rule that group matches; reduce with ``latest_alerts``. ``keep_window``
    adds the ``window`` struct (the event-time column) for a later stateful
    step on the stream, e.g. ``first_alerts``.
    """
    agg = _grouped(events, F.col("action").isin(*RULE_ACTIONS), rules, keys).agg(*rule_measures())
    return alerts_of(agg, rules, keys, keep_window)


def rule_measures(when: Column | None = None) -> list[Column]:
    """The four additive measures of the rules, over the rows for which ``when`` holds."""
    also = F.lit(True) if when is None else when
    is_login = (F.col("action") == LOGIN_FAILED) & also
    is_txn = (F.col("action") == TRANSACTION_SUCCESS) & also
    is_click = F.col("action").isin(*CLICK_ACTIONS) & also
    return [
        F.count_if(is_login).alias("n_login"),
        F.count_if(is_txn).alias("n_txn"),
        F.sum(F.when(is_txn, nan_to_null("amount"))).alias("txn_amount"),
        F.count_if(is_click).alias("n_click"),
    ]


def alerts_of(agg: DataFrame, rules: Rules, keys: Sequence[str] = DEFAULT_KEYS, keep_window: bool = False) -> DataFrame:
    """The alerts of measured windows: ``window``, the keys and the columns of :func:`rule_measures`."""
    n_login, n_txn, amount, n_click = (F.col(c) for c in MEASURES)
    candidates = [
        (BRUTE_FORCE, (n_login > 0) & (n_login >= rules.max_failed_logins), n_login, F.lit(0.0)),
        (VELOCITY, (n_txn > 0) & ((n_txn >= rules.max_transaction_velocity)
                                  | (amount >= rules.max_transaction_amount)), n_txn, amount),
        (BOT_BURST, (n_click > 0) & (n_click >= rules.max_clicks_per_window), n_click, F.lit(0.0)),
    ]
    # One slot per rule, NULL when it does not fire; exploded and filtered in
    # codegen-friendly steps (a lambda filter on the array would not be).
    slots = F.array(*[F.when(cond, F.struct(*_alert(kind, n, total))) for kind, cond, n, total in candidates])
    return agg.select(
        F.col("window"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *_key_cols(keys),
        F.explode(slots).alias("alert"),
    ).filter(F.col("alert").isNotNull()).select(
        "window_start", "window_end", *DEFAULT_KEYS, "alert.*",
        F.current_timestamp().alias("detection_timestamp"),
        *_event_time_col(keep_window),
    )
