"""The fused rules over panes (A1-A4, W1): a batch plan for hopping windows.

``detect_alerts`` copies an event into each of its r = window / slide windows
before the partial aggregate, and a (window, key) row per window is shuffled.
Counts and sums are additive, so here an event is measured once, in its pane
(the time between two window starts), and windows are put together from panes
after the shuffle.

Panes are grouped in blocks: a group (keys, block) holds the measures of
``2 (r - 1)`` panes in which windows start and of the r - 1 panes behind them
that those windows also cover. So an event goes to one or two blocks (1.5 on
average) instead of r windows, the partial aggregate folds a key's events of a
whole block into one row per task, and that row is all that is shuffled. Behind
the one exchange every window of a block is a sum of r columns of its own row:
no second grouping and no second exchange. A hot key is folded map-side.

For windows of more than ``MAX_PANES`` panes a block would need too many
columns: panes are grouped as rows first and then combined by window, with an
exchange for each of the two groupings. Both plans give the same rows as
``detect_alerts``. Batch only: a stream evicts state by window, so it keeps
``detect_alerts``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.operators.rules import DEFAULT_KEYS, MEASURES, RULE_ACTIONS, alerts_of, check_keys, rule_measures
from tripwire.schemas import Rules

MAX_PANES = 6


# Microseconds of the interval units that windows may be given in.
UNITS = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86_400 * 10**6,
         "week": 7 * 86_400 * 10**6}


def interval_micros(interval: str) -> int:
    """Microseconds of an interval such as ``5 minutes`` or ``1 day 2 hours`` (no months or years, as for windows)."""
    parts = re.findall(r"(\d+)\s+([a-z]+?)s?(?:\s+|$)", interval.strip().lower().removeprefix("interval "))
    if not parts or "".join(f"{n}{u}" for n, u in parts) != re.sub(r"\s+|s\b", "", interval.strip().lower().removeprefix("interval ")) or any(u not in UNITS for _, u in parts):
        raise ValueError(f"not an interval of whole {', '.join(UNITS)}s: {interval!r}")
    return sum(int(n) * UNITS[u] for n, u in parts)


def pane_size(rules: Rules) -> tuple[int, int, int]:
    """``(window, slide, pane)`` in microseconds; every window start and end is a multiple of the pane."""
    window, slide = interval_micros(rules.window), interval_micros(rules.slide)
    if not 0 < slide <= window:
        raise ValueError(f"need 0 < slide <= window, got {rules.slide} and {rules.window}")
    return window, slide, math.gcd(window, slide)


def floor_div(micros: Column, size: int) -> Column:
    """Whole multiples of ``size`` at or before ``micros`` (also before 1970)."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(size)), F.lit(size))


def _window(start: Column, size: int) -> Column:
    return F.struct(F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + F.lit(size)).alias("end"))


def _total(columns: list[Column], nullable: bool) -> Column:
    if not nullable:
        return sum(columns[1:], columns[0])
    zero = [F.coalesce(c, F.lit(0.0)) for c in columns]
    return F.when(F.coalesce(*columns).isNotNull(), sum(zero[1:], zero[0]))


def _by_blocks(rows: DataFrame, keys: Sequence[str], window: int, slide: int) -> DataFrame:
    """Windows whose length is a few slides: blocks of panes, one grouping."""
    r = window // slide
    starts = max(1, 2 * (r - 1))  # panes of a block in which windows start
    pane, place = F.col("pane"), F.pmod(F.col("pane"), F.lit(starts))
    own = floor_div(pane, starts)
    blocks = F.when(place < r - 1, F.array(own, own - 1)).otherwise(F.array(own))
    placed = rows.withColumn("block", F.explode(blocks)).withColumn("place", F.col("pane") - F.col("block") * starts)
    measures = []
    for i in range(starts + r - 1):
        measures += [c.alias(f"{name}_{i}") for name, c in zip(MEASURES, rule_measures(F.col("place") == i), strict=True)]
    agg = placed.groupBy(*keys, "block").agg(*measures)
    windows = F.array(*[
        F.struct(
            _window((F.col("block") * starts + i) * slide, window).alias("window"),
            *[_total([F.col(f"{name}_{j}") for j in range(i, i + r)], name == "txn_amount").alias(name) for name in MEASURES],
        )
        for i in range(starts)
    ])
    return agg.select(*keys, F.inline(windows))


def _by_rows(rows: DataFrame, keys: Sequence[str], window: int, slide: int, pane: int) -> DataFrame:
    """Windows of many panes: panes as rows, then windows of panes."""
    agg = rows.groupBy(*keys, "pane").agg(*rule_measures())
    at = F.col("pane") * pane
    first = floor_div(at + (pane - window - 1), slide) + 1  # the least start with start + window >= at + pane
    starts = F.explode(F.sequence(first, floor_div(at, slide))).alias("start")
    spread = agg.select(*keys, *MEASURES, starts)
    return (
        spread.groupBy(*keys, "start").agg(*[F.sum(m).alias(m) for m in MEASURES])
        .select(*keys, *MEASURES, _window(F.col("start") * slide, window).alias("window"))
    )


def detect_alerts_panes(events: DataFrame, rules: Rules = Rules(), keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """The same alerts as ``detect_alerts`` on a batch frame, from panes."""
    if events.isStreaming:
        raise ValueError("panes are a batch plan; on a stream use detect_alerts")
    check_keys(keys)
    window, slide, pane = pane_size(rules)
    rows = events.filter(F.col("action").isin(*RULE_ACTIONS) & F.col("event_time").isNotNull()).select(
        *keys, "action", "amount", floor_div(F.unix_micros("event_time"), pane).alias("pane"))
    if pane == slide and window // pane <= MAX_PANES:
        agg = _by_blocks(rows, keys, window, slide)
    else:
        agg = _by_rows(rows, keys, window, slide, pane)
    return alerts_of(agg, rules, keys)
