"""Stores of the live job, each a :class:`~tripwire.streaming.store.BatchStore`.

* :class:`WindowStore` - the hopping-window rules with a side output for late rows (ST2, ST3)
* :class:`AlertLog` - first-wins dedup against everything recorded so far (D1)
* :class:`AlertFanOut` - several alert sinks from one stateful aggregate (ST7, K2-K4)
* :class:`LatestView` - the latest version of every alert, kept up to date (D2, ST5)
* :class:`NewestRows` - the newest n alerts or events (L1, L2)
* :class:`EventStore` - events by date with closed days rewritten into few files (K1)
* :class:`TrailingStore` - the trailing-range rules as the clock moves (A5-A7)

What a batch reads back is bounded by what it changes or what the range holds,
never by the age of the job: closed time slots are dropped, logs are read for
the days a batch touches, and a view's untouched buckets are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripwire.operators.alerts import ALERT_KEYS, FIRST_KEYS, latest_alerts, new_alerts, recent_alerts, recent_events
from tripwire.operators.panes import floor_div, interval_micros, pane_size
from tripwire.operators.rules import DEFAULT_KEYS, MEASURES, RULE_ACTIONS, alerts_of, check_keys, rule_measures
from tripwire.operators.trailing import alerts_of_levels, by_pair_and_ip
from tripwire.schemas import ALERT_COLUMNS, ALERT_SCHEMA, PARSED_EVENT_SCHEMA, Rules
from tripwire.sources.parquet import read_alerts
from tripwire.streaming.store import BatchStore, children, drop, exists, read_parts, values

_MEASURE_TYPES = "n_login long, n_txn long, txn_amount double, n_click long"
_ALERTS = StructType([StructField(f.name, f.dataType, True) for f in ALERT_SCHEMA.fields])


def _latest_micros(events: DataFrame) -> int | None:
    return events.agg(F.max(F.unix_micros("event_time"))).first()[0]


def _between(micros: Column, low: int | None, high: int) -> Column:
    return (micros <= high) if low is None else (micros > low) & (micros <= high)


def _day(column: str) -> Column:
    """Whole days of a timestamp, in UTC whatever the session's zone."""
    return floor_div(F.unix_micros(column), 86_400_000_000)


class WindowStore(BatchStore):
    """The fused rules over hopping windows, closed by a watermark, with every late row accounted for.

    The watermark of a batch is the latest event time of the batches before it
    less the delay, in whole milliseconds. Before anything is aggregated each
    row is compared with it: windows that end at or before it are closed to the
    row. Rows with closed windows go to ``late`` with the list of those windows
    and whether any was open (``dropped``: none). All rows are measured by key and pane,
    with the watermark they met, in ``panes``, by time slots as long as a
    window. A batch then puts together the windows that its own rows close,
    from the panes of their slots, leaving out what came late, and writes the
    alerts to ``alerts``; slots that no open window needs are dropped.

    So for every event of the rules: its open windows + its closed windows = window / slide.
    """

    def __init__(self, path: str, rules: Rules = Rules(), keys: Sequence[str] = DEFAULT_KEYS):
        super().__init__(path)
        check_keys(keys)
        self.rules, self.keys = rules, tuple(keys)

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        spark = batch.sparkSession
        window, slide, pane = pane_size(self.rules)
        delay = interval_micros(self.rules.watermark)
        mark = before.get("watermark")
        batch = batch.persist()  # one parse for the four reads below
        try:
            latest = _latest_micros(batch)
            after = mark if latest is None else max(x for x in (mark, latest // 1000 * 1000 - delay) if x is not None)
            rows = batch.filter(F.col("event_time").isNotNull() & F.col("action").isin(*RULE_ACTIONS))
            at = F.unix_micros("event_time")
            # the windows of a row start after event time - window, at whole slides
            first = floor_div(at - F.lit(window), slide) + 1
            n_late = self._write_late(rows.withColumn("_at", at).withColumn("_first", first), batch_id, mark, window, slide)
            panes = rows.withColumn("pane", floor_div(at, pane)).groupBy(*self.keys, "pane").agg(*rule_measures())
            placed = panes.withColumn("slot", floor_div(F.col("pane") * pane, window)).withColumn("met", F.lit(mark).cast("long"))
            self.write_slots(placed, "panes", "slot", batch_id)
        finally:
            batch.unpersist()
        if after is not None and after != mark:
            self.write_batch(self._closed(spark, mark, after, window, slide, pane), "alerts", batch_id)
        if mark is not None:
            self._expire(spark, mark, window)  # not up to ``after``: a replay of this batch reads those slots again
        return {"watermark": after, **n_late}

    def _write_late(self, rows: DataFrame, batch_id: int, mark: int | None, window: int, slide: int) -> dict:
        starts = F.transform(F.sequence(F.col("_first"), floor_div(F.col("_at"), slide)), lambda k: k * slide)
        closed = F.filter(starts, lambda s: s + window <= F.lit(mark).cast("long"))
        late = (
            rows.withColumn("_closed", closed).filter(F.size("_closed") > 0)
            .withColumn("closed_windows", F.transform("_closed", F.timestamp_micros))
            .withColumn("dropped", F.size("_closed") == F.size(starts))
            .drop("_at", "_first", "_closed")
        )
        self.write_batch(late, "late", batch_id)
        written = rows.sparkSession.read.schema(late.schema).parquet(f"{self.path}/late/batch_id={batch_id}")
        n, dropped = written.agg(F.count("*"), F.count_if("dropped")).first()
        return {"late_rows": n, "dropped_rows": dropped}

    def _closed(self, spark: SparkSession, mark: int | None, after: int, window: int, slide: int, pane: int) -> DataFrame:
        """The alerts of the windows that end in ``(mark, after]``."""
        slots = [s for s in values(spark, f"{self.path}/panes", "slot")
                 if s * window <= after and (mark is None or (s + 2) * window > mark)]
        panes = read_parts(spark, f"{self.path}/panes", "slot", slots, self._pane_schema())
        at = F.col("pane") * pane
        first = floor_div(at + (pane - window - 1), slide) + 1
        end = F.col("start") + window
        measured = (
            panes.withColumn("start", F.explode(F.sequence(first, floor_div(at, slide)))).withColumn("start", F.col("start") * slide)
            .filter(_between(end, mark, after) & (F.col("met").isNull() | (end > F.col("met"))))
            .groupBy(*self.keys, "start").agg(*[F.sum(m).alias(m) for m in MEASURES])
        )
        bounds = F.struct(F.timestamp_micros("start").alias("start"), F.timestamp_micros(end).alias("end"))
        return alerts_of(measured.withColumn("window", bounds), self.rules, self.keys)

    def _pane_schema(self) -> str:
        return ", ".join([*[f"{k} string" for k in self.keys], "pane long", _MEASURE_TYPES, "met long", "slot long", "batch_id long"])

    def _expire(self, spark: SparkSession, mark: int, window: int) -> None:
        for slot in values(spark, f"{self.path}/panes", "slot"):
            if (slot + 2) * window <= mark:  # the last window that needs the slot's last pane is closed
                drop(spark, f"{self.path}/panes/slot={slot}")

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The alerts of all closed windows."""
        if not children(spark, f"{self.path}/alerts"):
            return spark.createDataFrame([], _ALERTS)
        return read_alerts(spark, f"{self.path}/alerts")

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """The rows that came behind the watermark: the events' columns, ``closed_windows`` (starts), ``dropped``, ``batch_id``."""
        return spark.read.parquet(f"{self.path}/late")


class AlertLog(BatchStore):
    """D1 on a stream: of the alerts of a batch those whose key no earlier batch recorded, first-wins within the batch.

    The log lies by the day of ``window_end``, so a batch reads back only the
    days its own alerts end on. Feed it update-mode alerts (early and repeated)
    or append-mode ones.
    """

    output_mode = "update"

    def __init__(self, path: str, keys: Sequence[str] = FIRST_KEYS):
        super().__init__(path)
        if "window_end" not in keys:
            raise ValueError("the log is looked up by the day of window_end: keep it among the keys")
        self.keys = tuple(keys)

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        spark = batch.sparkSession
        alerts = batch.select(*ALERT_COLUMNS).persist()
        try:
            day = _day("window_end")
            days = [r[0] for r in alerts.select(day.alias("d")).distinct().collect()]  # as many as a batch's windows have
            known = set(values(spark, f"{self.path}/log", "end_day"))
            recorded = self._read(spark, [d for d in days if d in known]).filter(F.col("batch_id") < batch_id)
            found = new_alerts(alerts, recorded, self.keys)
            self.write_slots(found.withColumn("end_day", day), "log", "end_day", batch_id)
        finally:
            alerts.unpersist()
        return {}

    def _read(self, spark: SparkSession, days: list[int]) -> DataFrame:
        schema = StructType(_ALERTS.fields + [StructField("end_day", LongType()), StructField("batch_id", LongType())])
        return read_parts(spark, f"{self.path}/log", "end_day", days, schema)

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The recorded alerts, with the batch that recorded them."""
        return self._read(spark, values(spark, f"{self.path}/log", "end_day")).drop("end_day")


class AlertFanOut(BatchStore):
    """Several alert sinks from one stateful aggregate (ST7, K2-K4).

    One update-mode query holds the only state store and reads the source once.
    Each batch's alerts go to ``updates`` (every change, by the day their window ends and by batch) and to the ``also``
    sinks (functions of the batch and its id: Kafka, console). When the query's
    watermark closes windows, the last version of their alerts is appended to
    ``alerts``, the rows an append-mode query of its own would write: once per
    window and final. The watermark of a batch is read from the offsets that
    the query's checkpoint records before the batch runs. (An alert whose total
    falls back below its threshold, by a negative amount, keeps its last version.)
    """

    output_mode = "update"

    def __init__(self, path: str, also: Sequence[Callable[[DataFrame, int], None]] = (), keys: Sequence[str] = ALERT_KEYS):
        super().__init__(path)
        self.also, self.keys, self.checkpoint = list(also), tuple(keys), None

    def start(self, stream, checkpoint, *args, **more):
        self.checkpoint = checkpoint.rstrip("/")
        return super().start(stream, checkpoint, *args, **more)

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            self.write_slots(batch.select(*ALERT_COLUMNS, _day("window_end").alias("end_day")), "updates", "end_day", batch_id)
            for sink in self.also:
                sink(batch, batch_id)
        finally:
            batch.unpersist()
        mark, last = batch_watermark(spark, self.checkpoint, batch_id), before.get("watermark")
        if mark is not None and mark != last:
            day = 86_400_000_000
            days = [d for d in values(spark, f"{self.path}/updates", "end_day") if d * day <= mark and (last is None or (d + 1) * day > last)]
            ended = self._updates(spark, days).filter(_between(F.unix_micros("window_end"), last, mark))
            self.write_batch(latest_alerts(ended.select(*ALERT_COLUMNS), self.keys), "alerts", batch_id)
        return {"watermark": mark}

    def _updates(self, spark: SparkSession, days: list[int]) -> DataFrame:
        schema = StructType(_ALERTS.fields + [StructField("end_day", LongType()), StructField("batch_id", LongType())])
        return read_parts(spark, f"{self.path}/updates", "end_day", days, schema)

    def updates(self, spark: SparkSession) -> DataFrame:
        """Every change of every alert, with the batch that made it."""
        return self._updates(spark, values(spark, f"{self.path}/updates", "end_day")).drop("end_day")

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The final alerts of the closed windows."""
        if not children(spark, f"{self.path}/alerts"):
            return spark.createDataFrame([], _ALERTS)
        return read_alerts(spark, f"{self.path}/alerts")


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int | None:
    """The watermark of a micro-batch in microseconds, as its query's checkpoint records it (None before the first event)."""
    for row in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect():  # a few lines
        if row[0].startswith("{") and "batchWatermarkMs" in row[0]:
            return json.loads(row[0])["batchWatermarkMs"] * 1000 or None
    return None


class LatestView(BatchStore):
    """D2 kept up to date: the latest version of every alert, in ``buckets`` folders by a hash of the alert's key.

    A batch rewrites the buckets that it has updates for (copy on write) into a
    version of its own and records which version each bucket is at; the others
    stay where they are. Readers see the last committed record, so never half a
    batch. Versions no record of the last ``keep_batches`` names are dropped.
    """

    output_mode = "update"
    keep_batches = 10

    def __init__(self, path: str, buckets: int = 64, keys: Sequence[str] = ALERT_KEYS):
        super().__init__(path)
        self.buckets, self.keys = buckets, tuple(keys)

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        spark = batch.sparkSession
        versions = {int(b): v for b, v in before.get("versions", {}).items()}
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        updates = batch.select(*ALERT_COLUMNS, bucket.alias("bucket")).persist()
        try:
            changed = sorted(r[0] for r in updates.select("bucket").distinct().collect())  # ``buckets`` numbers at most
            if changed:
                current = self._read(spark, {b: versions[b] for b in changed if b in versions})
                merged = latest_alerts(current.unionByName(updates), [*self.keys, "bucket"])
                # rows of a bucket meet in few tasks, so a bucket is few files
                merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={batch_id}")
        finally:
            updates.unpersist()
        old = {b: versions[b] for b in changed if b in versions}
        retired = [*before.get("retired", []), *[[batch_id, b, v] for b, v in old.items()]]
        for at, b, v in retired:
            if at <= batch_id - self.keep_batches:
                drop(spark, f"{self.path}/data/version={v}/bucket={b}")
        retired = [x for x in retired if x[0] > batch_id - self.keep_batches]
        return {"versions": versions | dict.fromkeys(changed, batch_id), "retired": retired, "rewritten": len(changed)}

    def _read(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        schema = "version long, bucket int"
        full = StructType(_ALERTS.fields + StructType.fromDDL(schema).fields)
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        if not paths:
            return spark.createDataFrame([], full).drop("version")
        return spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths).drop("version")

    def alerts(self, spark: SparkSession) -> DataFrame:
        """The latest version of every alert, as of the last committed batch."""
        last = self.last_batch(spark)
        versions = {} if last is None else self.commit(spark, last)["versions"]
        return self._read(spark, {int(b): v for b, v in versions.items()}).drop("bucket")


class NewestRows(BatchStore):
    """L1, L2: the newest ``n`` rows of a stream, newest first out of what came so far; the oldest are evicted.

    ``recent`` is :func:`recent_alerts` or :func:`recent_events` (or any function of
    a frame and n with a total order). A batch merges its own newest n with the
    n rows kept before: n rows are read back and n written, however long it runs.
    """

    def __init__(self, path: str, n: int, recent: Callable[[DataFrame, int], DataFrame] = recent_events):
        super().__init__(path)
        self.n, self.recent = n, recent

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        spark = batch.sparkSession
        newest = self.recent(batch, self.n)
        if batch_id:
            newest = self.recent(newest.unionByName(self._read(spark, batch_id - 1, batch.schema)), self.n)
        self.write_batch(newest, "newest", batch_id)
        drop(spark, f"{self.path}/newest/batch_id={batch_id - self.keep_batches}")
        return {}

    def _read(self, spark: SparkSession, batch_id: int, schema) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(f"{self.path}/newest/batch_id={batch_id}")

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows kept as of the last committed batch, newest first (``limit`` gives the newest of them)."""
        last = self.last_batch(spark)
        if last is None:
            raise ValueError(f"{self.path} holds no batch yet")
        return self.recent(self._read(spark, last, None), self.n)


def recent_alert_rows(path: str, n: int = 200) -> NewestRows:
    return NewestRows(path, n, recent_alerts)


def recent_event_rows(path: str, n: int = 1000) -> NewestRows:
    return NewestRows(path, n, recent_events)


class TrailingStore(BatchStore):
    """A5-A7 on a live stream: the trailing range's alerts after every batch.

    Events are measured by (user, ip) and time slot once, when they come, and
    kept as rows too. At ``as_of`` the range begins inside one slot: that slot's
    rows are filtered by time, all later slots come from their measures. So a
    batch reads the range's measures and one slot of rows, and slots before the
    range are dropped, as ``as_of`` never goes back.

    ``clock`` gives ``as_of`` in microseconds from the latest event time so far (also in microseconds, None
    before the first event); by default it is the wall clock, as for :func:`trailing_alerts`.
    """

    def __init__(self, path: str, rules: Rules = Rules(), slot: str = "10 seconds", clock: Callable[[int | None], int | None] | None = None):
        super().__init__(path)
        self.rules, self.slot = rules, slot
        self.clock = clock or (lambda latest: int(datetime.now(timezone.utc).timestamp() * 1_000_000))

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        spark = batch.sparkSession
        size = interval_micros(self.slot)
        keys = list(DEFAULT_KEYS)
        batch = batch.persist()
        try:
            latest = max((x for x in (before.get("latest"), _latest_micros(batch)) if x is not None), default=None)
            now = self.clock(latest)
            as_of = max((x for x in (before.get("as_of"), now) if x is not None), default=None)
            slot = floor_div(F.unix_micros("event_time"), size).alias("slot")
            start = None if as_of is None else as_of - self.rules.trailing_minutes * 60_000_000
            low = None if start is None else start // size
            rows = batch.filter(F.col("event_time").isNotNull() & F.col("action").isin(*RULE_ACTIONS)).select(
                *keys, "action", "amount", "event_time", slot)
            if low is not None:
                rows = rows.filter(F.col("slot") >= low)  # older slots are behind the range for good
            self.write_slots(rows, "rows", "slot", batch_id)
            self.write_slots(rows.groupBy(*keys, "slot").agg(*rule_measures()), "measures", "slot", batch_id)
        finally:
            batch.unpersist()
        if as_of is not None:
            self.write_batch(self._alerts(spark, start, as_of, low), "alerts", batch_id)
            for table in ("rows", "measures"):
                for old in values(spark, f"{self.path}/{table}", "slot"):
                    if old < low:
                        drop(spark, f"{self.path}/{table}/slot={old}")
        return {"latest": latest, "as_of": as_of}

    def _alerts(self, spark: SparkSession, start: int, as_of: int, low: int) -> DataFrame:
        keys = list(DEFAULT_KEYS)
        later = [s for s in values(spark, f"{self.path}/measures", "slot") if s > low]
        whole = read_parts(spark, f"{self.path}/measures", "slot", later, f"user_id string, ip_address string, {_MEASURE_TYPES}, slot long, batch_id long")
        first = [s for s in values(spark, f"{self.path}/rows", "slot") if s == low]
        part = read_parts(spark, f"{self.path}/rows", "slot", first, "user_id string, ip_address string, action string, amount double, event_time timestamp, slot long, batch_id long")
        part = part.filter(F.unix_micros("event_time") >= start).groupBy(*keys).agg(*rule_measures())
        measured = whole.select(*keys, *MEASURES).unionByName(part.select(*keys, *MEASURES))
        levels = by_pair_and_ip(measured, [F.sum(m).alias(m) for m in MEASURES])
        return alerts_of_levels(levels, self.rules, F.timestamp_micros(F.lit(start)), F.timestamp_micros(F.lit(as_of)))

    def alerts(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """The alerts after ``batch_id`` (the last committed batch by default)."""
        n = self.last_batch(spark) if batch_id is None else batch_id
        if n is None:
            return spark.createDataFrame([], _ALERTS)
        return read_alerts(spark, f"{self.path}/alerts/batch_id={n}")


class EventStore(BatchStore):
    """K1 with bounded files: events by date, batch and action, and closed days rewritten into few files.

    A batch writes its own folders under ``raw``. :meth:`compact` rewrites the
    days before a date into ``files`` files a folder under a version of its own, and
    then records, for each day, that version and the last batch it holds. Readers
    take a day from the version its record names, plus the batches behind it, so
    they see every row once before, while and after a day is rewritten, and late
    events of a rewritten day too (the next rewrite takes them in).
    """

    def apply(self, batch: DataFrame, batch_id: int, before: dict) -> dict:
        rows = batch.filter(F.col("event_time").isNotNull()).withColumn("event_date", _day("event_time"))
        (rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").partitionBy("event_date", "batch_id", "action")
         .option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/raw"))
        return {}

    def _record(self, spark: SparkSession) -> tuple[int, dict[int, list[int]]]:
        done = [v for v in values(spark, f"{self.path}/compactions", "version") if exists(spark, f"{self.path}/compactions/version={v}/_SUCCESS")]
        if not done:
            return -1, {}
        text = spark.read.text(f"{self.path}/compactions/version={done[-1]}").first()[0]
        return done[-1], {int(d): x for d, x in json.loads(text).items()}

    def _paths(self, spark: SparkSession, record: dict[int, list[int]], last: int, only: Sequence[int] | None = None) -> tuple[list[str], list[str]]:
        """Folders of the rewritten days, and of the batches behind them up to ``last``."""
        whole = [f"{self.path}/compact/version={v}/event_date={d}" for d, (v, _) in record.items() if only is None or d in only]
        raw = []
        for day in values(spark, f"{self.path}/raw", "event_date"):
            if only is None or day in only:
                behind = record.get(day, [0, -1])[1]
                raw += [f"{self.path}/raw/event_date={day}/batch_id={n}" for n in values(spark, f"{self.path}/raw/event_date={day}", "batch_id") if behind < n <= last]
        return whole, raw

    def _rows(self, spark: SparkSession, whole: list[str], raw: list[str]) -> DataFrame:
        schema = StructType([*PARSED_EVENT_SCHEMA.fields, StructField("event_date", LongType())])
        out = spark.createDataFrame([], schema)
        for base, paths in (("compact", whole), ("raw", raw)):
            if paths:
                out = out.unionByName(spark.read.schema(schema).option("basePath", f"{self.path}/{base}").parquet(*paths).select(*schema.names))
        return out

    def events(self, spark: SparkSession) -> DataFrame:
        """Every event of the committed batches, with ``event_date`` (days since 1970)."""
        last = self.last_batch(spark)
        return self._rows(spark, *self._paths(spark, self._record(spark)[1], -1 if last is None else last))

    def compact(self, spark: SparkSession, before_micros: int, files: int = 1) -> int:
        """Rewrite the days that end at or before ``before_micros`` and have batches not rewritten yet; returns how many."""
        last = self.last_batch(spark)
        version, record = self._record(spark)
        if last is None:
            return 0
        closed = [d for d in values(spark, f"{self.path}/raw", "event_date") if (d + 1) * 86_400_000_000 <= before_micros]
        days = [d for d in closed if self._paths(spark, record, last, [d])[1]]
        if not days:
            return 0
        version += 1
        bucket = F.pmod(F.xxhash64("event_id"), F.lit(files))
        (self._rows(spark, *self._paths(spark, record, last, days)).repartition("event_date", "action", bucket)
         .write.mode("overwrite").partitionBy("event_date", "action").parquet(f"{self.path}/compact/version={version}"))
        record |= {d: [version, last] for d in days}
        spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.path}/compactions/version={version}")
        return len(days)

    def vacuum(self, spark: SparkSession) -> None:
        """Drop what no reader of the newest record needs: rewritten batches and older versions. Call it when readers
        that began before the newest record have ended."""
        version, record = self._record(spark)
        for day, (kept, behind) in record.items():
            for n in values(spark, f"{self.path}/raw/event_date={day}", "batch_id"):
                if n <= behind:
                    drop(spark, f"{self.path}/raw/event_date={day}/batch_id={n}")
            for v in range(version + 1):
                if v != kept:
                    drop(spark, f"{self.path}/compact/version={v}/event_date={day}")
