"""Time every registered query and print one JSON line.

Environment:
  BENCH_SF_DIR   scale-factor directory (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] threads (default 8)
  BENCH_REPEAT   timed runs per query, median reported (default 3; long queries once)
  BENCH_KEYS     comma-separated subset of keys (default: all)

Each query is run to completion with the ``noop`` sink (the whole plan
executes, nothing is collected).  One untimed warm-up query runs first so JVM
start-up and code generation are not charged to the first key.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater import build_session  # noqa: E402
from tidewater.plans.catalog import REGISTRY  # noqa: E402


# Queries that take longer than this are timed once.
LONG_SECONDS = 20


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or list(REGISTRY)

    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="tidewater-bench",
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    run_once(spark, REGISTRY["dau_by_hour"].run, sf_dir)  # warm-up

    times: dict[str, float] = {}
    for key in keys:
        runs = [run_once(spark, REGISTRY[key].run, sf_dir)]
        # A long query's time varies little: it is run once.
        while len(runs) < repeat and runs[0] < LONG_SECONDS:
            runs.append(run_once(spark, REGISTRY[key].run, sf_dir))
        times[key] = round(statistics.median(runs), 3)
    spark.stop()

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))


if __name__ == "__main__":
    main()
