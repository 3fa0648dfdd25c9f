"""Plan-shape checks: the properties the scale design relies on."""

import re

import pytest

from tripwire.plans import QUERIES
from tripwire.plans.driver import DRIVER_RULES, events
from tripwire.operators import latest_event_time, detect_alerts, trailing_alerts, first_alerts, latest_alerts
from tripwire.sources import read_events
from tripwire.streaming import write_events

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "sliced_")))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def at_rest(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("rest") / "events")
    write_events(events(spark, SF), path)
    return read_events(spark, path)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_any_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(node in text for node in PYTHON_NODES), name


def test_each_payload_parsed_once(spark):
    assert plan(QUERIES["detect_alerts"](spark, SF)).count("from_json") == 1
    assert plan(QUERIES["parse_events"](spark, SF)).count("from_json") == 1


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning)", text)


def test_fused_rules_one_shuffle(at_rest):
    assert shuffles(plan(detect_alerts(at_rest, DRIVER_RULES))) == ["hashpartitioning"]


def test_trailing_one_shuffle_plus_scalar(at_rest):
    text = plan(trailing_alerts(at_rest, DRIVER_RULES))
    assert shuffles(text).count("hashpartitioning") == 1
    assert "Expand" in text  # the two grouping sets
    literal = plan(trailing_alerts(at_rest, DRIVER_RULES, as_of="2024-01-28 00:00:00"))
    assert "Subquery" not in literal and "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in literal


def test_dedup_and_latest_aggregate_partially(at_rest):
    alerts = detect_alerts(at_rest, DRIVER_RULES)
    assert "partial_min_by" in plan(first_alerts(alerts))
    assert "partial_max_by" in plan(latest_alerts(alerts))
    assert "Window" not in plan(first_alerts(alerts))


def test_trailing_prunes_date_partitions(spark, tmp_path):
    path = str(tmp_path / "by_date")
    write_events(events(spark, SF), path, by_date=True)
    ev = spark.read.parquet(path)
    for df in (trailing_alerts(ev, DRIVER_RULES, as_of=latest_event_time(ev)), trailing_alerts(ev, DRIVER_RULES, as_of="2024-01-28 00:00:00")):
        df.write.format("noop").mode("overwrite").save()
        scans = [line for line in plan(df).splitlines() if "FileScan" in line and "user_id" in line]
        assert scans and all("PartitionFilters: [isnotnull(event_date" in s and "event_date" in s.split("PartitionFilters")[1]
                             for s in scans)


# Plans that do work while being built, on purpose: split_valid_events checkpoints its decoded
# rows eagerly; backfill_from_sink and pipeline_alerts_from_events first run the streams whose
# output they read. (Streaming jobs run in their own job group, which the group-less job check
# below would not see.)
EAGER = ("split_valid_events", "split_rejected_events", "backfill_from_sink", "pipeline_alerts_from_events")
LAZY = [n for n in BATCH if n not in EAGER]


@pytest.mark.parametrize("name", LAZY)
def test_building_a_plan_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    QUERIES[name](spark, SF)
    assert set(tracker.getJobIdsForGroup(None)) == before, name
