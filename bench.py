"""Time every named plan at one scale and print one JSON line.

    BENCH_SF_DIR  scale directory (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    timed runs per plan, best kept (default 2)

Each run executes the whole plan into Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver). Streaming plans run their
availableNow query inside the timed call.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripwire.plans import QUERIES  # noqa: E402
from tripwire.plans.driver import PARTS_CONF  # noqa: E402
from tripwire.session import local_session  # noqa: E402


# A fixed set of core-operator plans: their sum stays comparable when plans are added.
CORE = ("parse_events", "brute_force", "transaction_velocity", "click_burst", "detect_alerts",
        "trailing_alerts", "first_alerts", "latest_alerts", "alert_kpis", "top_ips")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    spark = local_session(cpus, shuffle_partitions=cpus, app="tripwire-bench")
    # the test table is one row group: deal its rows out to all cores
    spark.conf.set(PARTS_CONF, str(cpus))

    def run(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(QUERIES["detect_alerts"])  # warm-up: JVM, code generation, file listing
    times, failed = {}, {}
    for name, fn in QUERIES.items():
        try:
            times[name] = round(min(run(fn) for _ in range(runs)), 3)
            print(f"bench {name}: {times[name]:.3f} s", file=sys.stderr, flush=True)
        except Exception as exc:  # keep measuring the others; report the failure
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"bench {name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sf = os.path.basename(sf_dir)
    print(json.dumps({
        "metric": "sum of best wall time per plan",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf[2:] if sf.startswith("sf") else sf,
        "cpus": cpus,
        "runs": runs,
        "core_sum": round(sum(times[q] for q in CORE if q in times), 3),
        "events": n_events,
        # raw payloads -> parse -> all three sliding-window rules, per second of wall time
        "flagship_events_per_sec": round(n_events / times["detect_alerts"]) if "detect_alerts" in times else None,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
