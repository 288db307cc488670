"""Micro-batch latency of the streaming jobs on realistic batch sizes.

Splits the scale factor's events/orders/lineitem into daily files (written
one after the other, so arrival follows time), streams them one file per
trigger and prints one JSON line with per-job batch durations (ms) and rows/s.

    python scripts/stream_latency.py [/root/testdata/sf0.1] [days]
"""

from __future__ import annotations

import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidewater import build_session  # noqa: E402
from tidewater.plans import catalog  # noqa: E402
from tidewater.session import scratch_path  # noqa: E402
from tidewater.sources.tables import Tables  # noqa: E402
from tidewater.streaming import jobs  # noqa: E402


def split_by_day(df, ts_col: str, path: str, days: int, drop=()) -> None:
    """One file per time slice (appended in time order); the slice bounds
    come from an aggregate, the data never leaves the executors."""
    day = F.floor(F.unix_seconds(F.col(ts_col).cast("timestamp")) / 86400)
    lo, hi = df.agg(F.min(day), F.max(day)).first()
    step = max(1, (hi - lo + 1) // days)
    for start in range(lo, hi + 1, step):
        piece = df.where((day >= start) & (day < start + step)).drop(*drop)
        piece.coalesce(1).write.mode("append").parquet(path)


def summary(query) -> dict:
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    ms = [p["durationMs"]["triggerExecution"] for p in batches]
    rows = sum(p["numInputRows"] for p in batches)
    return {"batches": len(ms), "p50_ms": statistics.median(ms), "max_ms": max(ms),
            "rows": rows, "rows_per_s": round(rows / (sum(ms) / 1000.0), 1)}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    days = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    spark = build_session("local[8]", 16, app_name="tidewater-stream-latency")
    t = Tables(spark, sf_dir)
    split = scratch_path(spark, "latency-input")
    split_by_day(t.events, "ts", f"{split}/events", days)
    orders = t.orders.select("o_orderkey", "o_orderdate")
    li = t.lineitem
    split_by_day(t.orders, "o_orderdate", f"{split}/orders", days)
    split_by_day(li.join(orders, li.l_orderkey == orders.o_orderkey).drop("o_orderkey"), "o_orderdate",
                 f"{split}/lineitem", days, drop=("o_orderdate",))
    once = {"availableNow": True}
    out = {}
    q, _ = jobs.run_dau(spark, sf_dir, trigger=once, max_files_per_trigger=1, stream_dir=split)
    out["dau"] = summary(q)
    q, _ = jobs.run_alert_counts(spark, sf_dir, trigger=once, max_files_per_trigger=1, stream_dir=split)
    out["alerts_30s_5s"] = summary(q)
    q, _ = jobs.run_sale_upsert(spark, sf_dir, catalog.AGE_ASOF, trigger=once, max_files_per_trigger=1,
                                stream_dir=split)
    out["sale_detail"] = summary(q)
    print(json.dumps({"sf_dir": sf_dir, "slices": days, "jobs": out}))


if __name__ == "__main__":
    main()
