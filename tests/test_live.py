"""The live job's stores: batches in order, replayed, and cut off before their commit."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tripwire.operators import detect_alerts, first_alerts, latest_alerts, recent_alerts, recent_events, trailing_alerts
from tripwire.plans import QUERIES
from tripwire.plans.driver import DRIVER_RULES, _live_alerts, _once
from tripwire.schemas import ALERT_COLUMNS, ALERT_SCHEMA, CLICK_ACTIONS, LOGIN_FAILED, TRANSACTION_SUCCESS, Rules
from tripwire.sources import read_event_slices
from tripwire.streaming import AlertFanOut, AlertLog, EventStore, LatestView, TrailingStore, WindowStore, live, recent_alert_rows, recent_event_rows, replay
from tripwire.streaming.store import children, drop, values

START = datetime(2025, 6, 30, 23, 50, tzinfo=timezone.utc)
ACTIONS = [LOGIN_FAILED, TRANSACTION_SUCCESS, *CLICK_ACTIONS, "logout"]
SCHEMA = "event_id string, user_id string, ip_address string, action string, amount double, event_time timestamp"
EVERY = Rules(max_failed_logins=1, max_transaction_velocity=1, max_clicks_per_window=1)
SF = "/root/testdata/sf0.001"


def batches(seed=3, n=4, each=60, late=0.25):
    """Events of advancing minutes; a share of each batch is up to half an hour older."""
    rng, out = random.Random(seed), []
    for b in range(n):
        rows = []
        for k in range(each):
            back = rng.randrange(40 * 60) if rng.random() < late else 0
            at = START + timedelta(minutes=12 * b, seconds=rng.randrange(720) - back, microseconds=rng.randrange(10**6))
            rows.append((f"{b}-{k}", rng.choice(["u", "v", None]), rng.choice(["i", "j"]), rng.choice(ACTIONS), rng.choice([1.5, 20.0, None]), at))
        out.append(rows)
    return out


def frames(spark, parts):
    return [spark.createDataFrame(rows, SCHEMA) for rows in parts]


def key(df, *columns):
    return Counter(tuple(str(round(r[c], 6)) if isinstance(r[c], float) else str(r[c]) for c in columns) for r in df.collect())


ALERT = [c for c in ALERT_COLUMNS if c != "detection_timestamp"]


# ---------------------------------------------------------------- late rows

def window_brute(parts, rules_minutes=5, delay=timedelta(minutes=10)):
    """Open and closed (event, window start) pairs."""
    mark, open_pairs, closed_pairs = None, [], []
    for rows in parts:
        for r in rows:
            minute = r[5].replace(second=0, microsecond=0)
            for i in range(rules_minutes):
                start = minute - timedelta(minutes=i)
                late = mark is not None and start + timedelta(minutes=rules_minutes) <= mark
                (closed_pairs if late else open_pairs).append((r, start))
        latest = max(r[5] for r in rows)
        latest = latest.replace(microsecond=latest.microsecond // 1000 * 1000) - delay
        mark = latest if mark is None else max(mark, latest)
    return open_pairs, closed_pairs


def test_aggregated_rows_and_late_rows_are_all_rows(spark, scratch):
    parts = batches()
    parts.append([("end", "z", "z", "logout", None, START + timedelta(days=1))])  # closes everything before
    store = WindowStore(scratch, EVERY)
    for n, frame in enumerate(frames(spark, parts)):
        store.handle(frame, n)
    relevant = [[r for r in rows if r[3] != "logout"] for rows in parts]
    open_pairs, closed_pairs = window_brute(parts)
    open_pairs, closed_pairs = ([p for p in pairs if p[0][3] != "logout"] for pairs in (open_pairs, closed_pairs))
    late = store.late_rows(spark).collect()
    assert closed_pairs and open_pairs
    assert Counter((r["event_id"], s.replace(tzinfo=timezone.utc)) for r in late for s in r["closed_windows"]) == Counter((r[0], s) for r, s in closed_pairs)
    assert {r["event_id"] for r in late if r["dropped"]} == {r[0] for r, _ in closed_pairs} - {r[0] for r, _ in open_pairs}
    counted = Counter((s, r[1], r[2], "click" if r[3] in CLICK_ACTIONS else r[3]) for r, s in open_pairs)
    kinds = {"CREDENTIAL_STUFFING_BRUTE_FORCE": LOGIN_FAILED, "TRANSACTION_VELOCITY_SPIKE": TRANSACTION_SUCCESS, "BOT_SCRAPING_BURST": "click"}
    alerts = store.alerts(spark).collect()
    assert {(a["window_start"].replace(tzinfo=timezone.utc), a["user_id"], a["ip_address"], kinds[a["anomaly_type"]]): a["event_count"] for a in alerts} == counted
    assert len(alerts) == len(counted)  # every window once
    # conservation: rows with an open window and dropped rows, and pairs of rows and windows
    n = sum(map(len, relevant))
    assert sum(a["event_count"] for a in alerts) + sum(len(r["closed_windows"]) for r in late) == 5 * n
    assert len({r[0] for r, _ in open_pairs}) + sum(r["dropped"] for r in late) == n


def test_window_store_replays_and_forgets(spark, scratch):
    parts = batches(seed=8, n=3)
    store, twice = WindowStore(f"{scratch}/a", EVERY), WindowStore(f"{scratch}/b", EVERY)
    for n, frame in enumerate(frames(spark, parts)):
        store.handle(frame, n)
        twice.handle(frame, n)
        drop(spark, f"{scratch}/b/commits/batch_id={n}")  # died between its last write and its commit
        twice.handle(frame, n)
        twice.handle(frame, n)  # replayed though committed
    assert key(store.alerts(spark), *ALERT) == key(twice.alerts(spark), *ALERT)
    assert key(store.late_rows(spark), "event_id", "closed_windows", "dropped", "batch_id") == key(twice.late_rows(spark), "event_id", "closed_windows", "dropped", "batch_id")
    mark = store.commit(spark, 1)["watermark"]
    assert all((s + 2) * 300_000_000 > mark for s in values(spark, f"{scratch}/a/panes", "slot"))
    with pytest.raises(ValueError):
        WindowStore(f"{scratch}/other", EVERY).handle(frame, 3)


def test_window_store_without_late_rows_equals_the_batch(spark, scratch):
    rows = batches(n=3, late=0.0)
    store = WindowStore(scratch, EVERY)
    for n, frame in enumerate(frames(spark, rows)):
        store.handle(frame, n)
    store.handle(spark.createDataFrame([], SCHEMA), 3)
    mark = store.commit(spark, 3)["watermark"]
    every = spark.createDataFrame([r for part in rows for r in part], SCHEMA)
    batch = detect_alerts(every, EVERY).filter(F.unix_micros("window_end") <= mark)
    assert key(store.alerts(spark), *ALERT) == key(batch, *ALERT)
    assert store.late_rows(spark).count() == 0


# ---------------------------------------------------------------- alerts over time

def updates(seed=5, n=5):
    """Batches of alerts as update mode gives them: windows that come again with higher counts."""
    rng, counts, out = random.Random(seed), Counter(), []
    for b in range(n):
        rows = []
        for _ in range(30):
            start = START + timedelta(minutes=rng.randrange(40))
            who = (rng.choice(["u", "v", None]), rng.choice(["i", "j"]), rng.choice(["A", "B"]))
            counts[start, who] += 1
            rows = [r for r in rows if (r[0], (r[2], r[3], r[4])) != (start, who)]
            rows.append((start, start + timedelta(minutes=5), *who, "HIGH", counts[start, who], 0.0, "d", START + timedelta(hours=b)))
        out.append(rows)
    return out


def alert_frames(spark, parts):
    return [spark.createDataFrame(rows, ALERT_SCHEMA) for rows in parts]


def run_all(store, parts):
    for n, frame in enumerate(parts):
        store.handle(frame, n)


def test_alert_log_keeps_the_first_of_each_key(spark, scratch, monkeypatch):
    parts = alert_frames(spark, updates())
    log = AlertLog(f"{scratch}/log")
    run_all(log, parts)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    want = key(first_alerts(every), *ALERT_COLUMNS)
    assert key(log.alerts(spark), *ALERT_COLUMNS) == want
    # a replayed batch adds nothing, also if it died before its commit
    log.handle(parts[2], 2)
    drop(spark, f"{scratch}/log/commits/batch_id=4")
    log.handle(parts[4], 4)
    assert key(log.alerts(spark), *ALERT_COLUMNS) == want
    # without the anti-join the log has alerts twice
    monkeypatch.setattr(live, "new_alerts", lambda found, recorded, keys: first_alerts(found, keys))
    wrong = AlertLog(f"{scratch}/wrong")
    run_all(wrong, parts)
    assert sum(key(wrong.alerts(spark), *ALERT_COLUMNS).values()) > sum(want.values())


def test_alert_log_reads_only_the_days_of_a_batch(spark, scratch):
    log = AlertLog(scratch)
    run_all(log, alert_frames(spark, updates()))
    days = values(spark, f"{scratch}/log", "end_day")
    assert len(days) == 2  # the windows cross midnight
    drop(spark, f"{scratch}/log/end_day={days[1]}")
    other = [r for part in updates() for r in part if r[1].date().toordinal() - 719163 == days[0]]
    before = log.alerts(spark).count()
    log.handle(spark.createDataFrame(other[:5], ALERT_SCHEMA), 5)
    assert log.alerts(spark).count() == before
    with pytest.raises(ValueError):
        AlertLog(scratch, keys=("user_id",))


def test_latest_view_equals_the_whole_log(spark, scratch):
    parts = alert_frames(spark, updates(seed=6, n=4))
    view = LatestView(scratch, buckets=8)
    every = None
    for n, part in enumerate(parts):
        view.handle(part, n)
        every = part if every is None else every.unionByName(part)
        assert key(view.alerts(spark), *ALERT_COLUMNS) == key(latest_alerts(every), *ALERT_COLUMNS), n
    # a batch of one alert rewrites one bucket, and the others stay at their versions
    before = view.commit(spark, 3)["versions"]
    one = parts[0].limit(1)
    view.handle(one, 4)
    record = view.commit(spark, 4)
    assert record["rewritten"] == 1 and sum(record["versions"][b] != v for b, v in before.items()) == 1
    assert children(spark, f"{scratch}/data/version=4") == ["_SUCCESS", *[f"bucket={b}" for b, v in record["versions"].items() if v == 4]]
    want = key(view.alerts(spark), *ALERT_COLUMNS)
    drop(spark, f"{scratch}/commits/batch_id=4")
    view.handle(one, 4)
    view.handle(one, 4)
    assert key(view.alerts(spark), *ALERT_COLUMNS) == want


def test_latest_view_drops_old_versions(spark, scratch):
    view = LatestView(scratch, buckets=1)
    view.keep_batches = 2
    parts = alert_frames(spark, updates(seed=1, n=5))
    run_all(view, parts)
    left = [v for v in values(spark, f"{scratch}/data", "version") if children(spark, f"{scratch}/data/version={v}/bucket=0")]
    assert left == [2, 3, 4]
    assert key(view.alerts(spark), *ALERT_COLUMNS) == key(latest_alerts(_union(parts)), *ALERT_COLUMNS)
    empty = LatestView(f"{scratch}/none")
    assert empty.alerts(spark).count() == 0


def _union(parts):
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@pytest.mark.parametrize("n", [1, 25, 1000])
def test_newest_rows_equal_those_of_all(spark, scratch, n):
    parts = frames(spark, batches(seed=2, n=3))
    store = recent_event_rows(f"{scratch}/events", n)
    alerts = alert_frames(spark, updates(n=3))
    feed = recent_alert_rows(f"{scratch}/alerts", n)
    for k in range(3):
        store.handle(parts[k], k)
        feed.handle(alerts[k], k)
        assert [r["event_id"] for r in store.rows(spark).collect()] == [r["event_id"] for r in recent_events(_union(parts[: k + 1]), n).collect()]
        assert feed.rows(spark).collect() == recent_alerts(_union(alerts[: k + 1]), n).collect()
    drop(spark, f"{scratch}/events/commits/batch_id=2")
    store.handle(parts[2], 2)
    assert store.rows(spark).count() == min(n, 180)


# ---------------------------------------------------------------- trailing range

@pytest.mark.parametrize("slot", ["10 seconds", "7 minutes"])
def test_trailing_store_equals_the_batch_rules(spark, scratch, slot):
    rules = Rules(trailing_failed_logins=2, trailing_transaction_velocity=2, trailing_transaction_amount=30.0, trailing_clicks_per_ip=3, trailing_minutes=15)
    parts = batches(seed=11, n=4)
    store = TrailingStore(scratch, rules, slot=slot, clock=lambda latest: latest)
    so_far = []
    for n, rows in enumerate(parts):
        store.handle(spark.createDataFrame(rows, SCHEMA), n)
        so_far += rows
        every = spark.createDataFrame(so_far, SCHEMA)
        as_of = max(r[5] for r in so_far)
        want = key(trailing_alerts(every, rules, as_of=as_of), *ALERT_COLUMNS)
        assert want and key(store.alerts(spark, n), *ALERT_COLUMNS) == want, n
    size = {"10 seconds": 10, "7 minutes": 420}[slot]
    low = (int(as_of.timestamp()) - 900) // size
    assert min(values(spark, f"{scratch}/rows", "slot")) >= low  # what lies behind the range is gone
    drop(spark, f"{scratch}/commits/batch_id=3")
    store.handle(spark.createDataFrame(parts[3], SCHEMA), 3)
    assert key(store.alerts(spark), *ALERT_COLUMNS) == want


def test_trailing_store_as_the_clock_moves(spark, scratch):
    rules = Rules(trailing_failed_logins=2)
    now = [int(START.timestamp()) * 1_000_000]
    store = TrailingStore(scratch, rules, clock=lambda latest: now[0])
    login = [(str(k), "u", "i", LOGIN_FAILED, 0.0, START - timedelta(seconds=30 * k)) for k in range(8)]
    store.handle(spark.createDataFrame(login, SCHEMA), 0)
    assert [a["event_count"] for a in store.alerts(spark, 0).collect()] == [8]
    nothing = spark.createDataFrame([], SCHEMA)
    for n, (minutes, counts) in enumerate([(2, [7]), (4, [3]), (5, []), (4, [])], 1):
        now[0] = int((START + timedelta(minutes=minutes)).timestamp()) * 1_000_000
        store.handle(nothing, n)
        assert [a["event_count"] for a in store.alerts(spark, n).collect()] == counts, n


# ---------------------------------------------------------------- events in few files

def test_compaction_shows_every_row_once(spark, scratch, monkeypatch):
    parts = frames(spark, batches(seed=4, n=5, each=80, late=0.4))
    parts = [p.withColumns({c: F.lit("x") for c in ("timestamp", "session_id", "device_type", "location_country", "location_city", "url_path", "user_agent")}) for p in parts]
    store = EventStore(scratch)
    ids = lambda: sorted(r[0] for r in store.events(spark).select("event_id").collect())
    want = lambda n: sorted(f"{b}-{k}" for b in range(n) for k in range(80))
    for n in range(3):
        store.handle(parts[n], n)
    midnight = int(datetime(2025, 7, 1, tzinfo=timezone.utc).timestamp()) * 1_000_000
    assert store.compact(spark, midnight - 1) == 0  # the day is not over
    # while it is rewritten: the new version is there, its record is not
    commits = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, schema=None, **kw: (_ for _ in ()).throw(RuntimeError("died")) if schema == "value string" else commits(self, rows, schema, **kw))
    with pytest.raises(RuntimeError):
        store.compact(spark, midnight)
    assert children(spark, f"{scratch}/compact") == ["version=0"] and ids() == want(3)
    monkeypatch.undo()
    assert store.compact(spark, midnight) == 1 and ids() == want(3)
    files = [f for f in store.events(spark).inputFiles() if "/compact/" in f]
    assert 0 < len(files) <= len(ACTIONS) and store.compact(spark, midnight) == 0
    # late events of the rewritten day, before and after the next rewrite and the clean-up
    for n in (3, 4):
        store.handle(parts[n], n)
    old = sum(r[0] < 20270 for r in parts[3].unionByName(parts[4]).select(F.unix_date(F.to_date("event_time"))).collect())
    assert old > 0 and ids() == want(5)
    assert store.compact(spark, midnight) == 1 and ids() == want(5)
    store.vacuum(spark)
    assert ids() == want(5)
    day = min(values(spark, f"{scratch}/raw", "event_date"))
    assert values(spark, f"{scratch}/raw/event_date={day}", "batch_id") == []
    assert len([f for f in store.events(spark).inputFiles() if f"event_date={day}" in f]) <= len(ACTIONS)


def test_a_batch_without_commit_is_not_read(spark, scratch):
    store = EventStore(scratch)
    frame = frames(spark, batches(n=1))[0].withColumns({c: F.lit("x") for c in ("timestamp", "session_id", "device_type", "location_country", "location_city", "url_path", "user_agent")})
    assert store.events(spark).count() == 0 and store.compact(spark, 10**18) == 0
    store.handle(frame, 0)
    store.handle(frame, 1)
    drop(spark, f"{scratch}/commits/batch_id=1")
    assert store.events(spark).count() == 60
    store.handle(frame, 1)
    assert store.events(spark).count() == 120


# ---------------------------------------------------------------- over real runs

def test_three_runs_drop_late_rows_and_keep_state(spark, scratch):
    from tripwire.streaming import write_alert_updates, write_alerts

    reports = replay(spark, read_event_slices(spark, SF), f"{scratch}/source", lambda raw: write_alerts(
        _live_alerts(raw), f"{scratch}/alerts", f"{scratch}/ck", **_once(spark)))
    assert len(reports) == 3
    assert sum(b["dropped_late_rows"] for b in reports[2]) > 0
    assert reports[1][0]["state_rows"] > 0 and min(b["batch_id"] for b in reports[2]) > max(b["batch_id"] for b in reports[0])
    replay(spark, read_event_slices(spark, SF), f"{scratch}/source2", lambda raw: write_alert_updates(
        _live_alerts(raw), f"{scratch}/updates", f"{scratch}/ck2", **_once(spark)))
    log = spark.read.parquet(f"{scratch}/updates")
    assert log.count() > latest_alerts(log.select(*ALERT_COLUMNS)).count()  # alerts that changed between runs


def test_fan_out_has_one_state_store_and_one_read(spark, scratch):
    seen, queries = [], []
    out = AlertFanOut(f"{scratch}/out", also=[lambda batch, n: seen.append((n, batch.count()))])

    def start(raw):
        queries.append(out.start(_live_alerts(raw), f"{scratch}/ck", **_once(spark)))
        return queries[-1]

    replay(spark, read_event_slices(spark, SF), f"{scratch}/source", start)
    for q in queries:
        for p in q.recentProgress:
            assert len(p["sources"]) == 1 and len(p["stateOperators"]) == 1
    assert [n for n, _ in seen] == sorted({n for n, _ in seen}) and sum(c for _, c in seen) == out.updates(spark).count()
    want = QUERIES["sliced_alerts_append"](spark, SF)
    got = out.alerts(spark)
    names = [c for c in want.columns if c not in ("total_amount", "window_start", "window_end")]
    assert key(got, *names) == key(want, *names)
    assert out.updates(spark).count() > got.count()


def test_slices_are_the_whole_table(spark):
    parts = read_event_slices(spark, SF)
    n = spark.read.parquet(f"{SF}/events.parquet").count()
    assert len(parts) == 3 and sum(p.count() for p in parts) == n
    assert DRIVER_RULES.watermark == "10 minutes"


def test_pipeline_with_one_aggregate_for_all_alert_sinks(spark, scratch, capsys):
    from tripwire.sources import read_event_records
    from tripwire.streaming import PipelineSpec, run_once, start_pipeline

    raw = read_event_records(spark, SF, streaming=True)
    spec = PipelineSpec(f"{scratch}/events", f"{scratch}/alerts", f"{scratch}/ck", DRIVER_RULES, trigger={"availableNow": True},
                        state_partitions=2, console=True, one_aggregate=True)
    queries = start_pipeline(spark, raw, spec)
    assert [q.name for q in queries] == ["events_parquet", "alerts_fan_out"]
    for q in queries:
        run_once(q)
    assert sum(len(p["stateOperators"]) for p in queries[1].recentProgress) == len(queries[1].recentProgress)
    out = AlertFanOut(f"{scratch}/alerts")
    names = ("user_id", "ip_address", "anomaly_type", "event_count")
    assert key(out.alerts(spark), *names) == key(QUERIES["stream_alerts_append"](spark, SF), *names)
    assert key(latest_alerts(out.updates(spark).drop("batch_id")), *names) == key(QUERIES["detect_alerts"](spark, SF), *names)
