"""Per-stage task times of a named plan, from Spark's event log.

    python tools/stage_times.py detect_alerts [/root/testdata/sf0.1] [--runs 2]

Runs the plan (into the ``noop`` sink) with the event log written to a fresh
scratch folder, then prints for every stage of the last run: task count and
min / median / max task time. A max far above the median is a straggler (skew).
No UI or server is started; the event log is a plain file.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(log_dir: str):
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*local-*")):
        if os.path.isdir(path):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("plan")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.1")
    ap.add_argument("--runs", type=int, default=2, help="runs; stages of the last one are shown")
    ap.add_argument("--cpus", type=int, default=8, help="local cores (and shuffle partitions)")
    ap.add_argument("--parts", type=int, default=0, help="deal the test table's rows out to so many tasks")
    args = ap.parse_args()

    from pyspark.sql import SparkSession

    from tripwire.plans import QUERIES
    from tripwire.plans.driver import PARTS_CONF
    from tripwire.session import ENGINE_CONF

    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    builder = (SparkSession.builder.master(f"local[{args.cpus}]").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(args.cpus))
               .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(PARTS_CONF, str(args.parts))
    for i in range(args.runs):
        spark.sparkContext.setJobGroup(f"run{i}", args.plan)
        QUERIES[args.plan](spark, args.sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    last_group = f"run{args.runs - 1}"
    stages_of_last, names, durations, rows_in, rows_out = set(), {}, {}, {}, {}
    for e in read_events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            if (e.get("Properties") or {}).get("spark.jobGroup.id") == last_group:
                stages_of_last.update(e["Stage IDs"])
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            names[info["Stage ID"]] = info["Stage Name"].split(" at ")[0]
        elif kind == "SparkListenerTaskEnd":
            t, m, stage = e["Task Info"], e.get("Task Metrics") or {}, e["Stage ID"]
            durations.setdefault(stage, []).append(t["Finish Time"] - t["Launch Time"])
            read = (m.get("Input Metrics") or {}).get("Records Read", 0) + \
                (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            rows_in[stage] = rows_in.get(stage, 0) + read
            rows_out[stage] = rows_out.get(stage, 0) + (m.get("Shuffle Write Metrics") or {}).get(
                "Shuffle Records Written", 0)
    print(f"{args.plan} on {args.sf_dir} (event log: {log_dir})")
    print(f"{'stage':>5} {'tasks':>5} {'min ms':>7} {'median':>7} {'max ms':>7} {'rows in':>10} {'shuffled':>10}")
    for stage in sorted(s for s in stages_of_last if s in durations):
        d = durations[stage]
        print(f"{stage:>5} {len(d):>5} {min(d):>7} {statistics.median(d):>7.0f} {max(d):>7} "
              f"{rows_in.get(stage, 0):>10,} {rows_out.get(stage, 0):>10,}")


if __name__ == "__main__":
    main()
