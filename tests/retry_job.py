"""Run by test_retry.py in its own JVM (local[4,3]: a task may fail twice).

Some input tasks fail on their first attempt (as when an executor is lost);
the retried job must produce exactly the alerts of a clean run.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tripwire.operators import detect_alerts, parse_events  # noqa: E402
from tripwire.plans.driver import DRIVER_RULES, comparable_alerts  # noqa: E402
from tripwire.session import ENGINE_CONF  # noqa: E402
from tripwire.sources import read_event_records  # noqa: E402


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task loss")
    yield from batches


def main(sf_dir: str) -> None:
    builder = SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    records = read_event_records(spark, sf_dir)
    clean = comparable_alerts(detect_alerts(parse_events(records), DRIVER_RULES)).collect()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("retried", "flaky input")
    retried = comparable_alerts(detect_alerts(parse_events(records.mapInPandas(flaky, records.schema)),
                                              DRIVER_RULES)).collect()
    failed = 0
    for job in tracker.getJobIdsForGroup("retried"):
        for stage in tracker.getJobInfo(job).stageIds:
            info = tracker.getStageInfo(stage)
            failed += info.numFailedTasks if info else 0
    print(json.dumps({"clean": len(clean), "retried": len(retried), "failed_attempts": failed > 0,
                      "equal": sorted(map(tuple, clean)) == sorted(map(tuple, retried))}, default=str))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
