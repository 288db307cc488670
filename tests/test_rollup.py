"""Aggregates kept current, as-of joins."""

import bisect
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.asof import asof_join
from tidewater.plans import catalog
from tidewater.session import scratch_path
from tidewater.sinks.rollup import Rollup
from tidewater.sources import fixtures as fx
from tidewater.sources.tables import Tables
from tidewater.streaming import dashboard, jobs

from .conftest import SF_SMALL
from .test_streaming import AVAILABLE_NOW, rows

ROWS = "id string, day string, hour string, amount long"


def current(history):
    newest = {}
    for batch in history:
        newest.update({r[0]: r for r in batch})
    out = {}
    for _, day, hour, amount in newest.values():
        n, total = out.get((day, hour), (0, 0))
        out[day, hour] = (n + 1, total + amount)
    return {(d, h, n, total) for (d, h), (n, total) in out.items()}


def test_rollup_equals_recount_after_every_batch(spark):
    random.seed(9)
    table = Rollup(scratch_path(spark, "rollup"), ("id",), ("day", "hour"), ("n", "amount"), "day")
    history = []
    for batch_id in range(6):
        ids = random.sample(range(40), 15)
        # A key keeps its day, which is its folder, and moves between hours.
        batch = [(f"k{i}", f"d{i % 3}" if i else None, random.choice(["00", "07", "23"]), random.randrange(100)) for i in ids]
        history.append(batch)
        frame = spark.createDataFrame(batch, ROWS).withColumn("n", F.lit(1).cast("long"))
        for _ in range(2 if batch_id in (0, 3) else 1):  # replayed batches change nothing
            table.apply(frame, batch_id)
        got = {tuple(r) for r in table.read(spark).select("day", "hour", "n", "amount").collect()}
        assert got == current(history)
    table.fold(spark, 4)
    assert {tuple(r) for r in table.read(spark).select("day", "hour", "n", "amount").collect()} == current(history)
    table.apply(spark.createDataFrame(history[0], ROWS).withColumn("n", F.lit(1).cast("long")), 6)
    assert {tuple(r) for r in table.read(spark).select("day", "hour", "n", "amount").collect()} == current([*history, history[0]])
    table.apply(spark.createDataFrame([], ROWS).withColumn("n", F.lit(1).cast("long")), 7)


def test_dau_dashboard_after_each_of_many_slices(spark):
    t = Tables(spark, SF_SMALL)
    folder = scratch_path(spark, "events")
    run = jobs.StreamRun.fresh(spark, "dashboard")
    moved = 0
    seen = None
    for i in range(6):
        part = t.events.where(F.col("event_id") % 6 == i).coalesce(1)
        part.write.mode("append").parquet(f"{folder}/events")
        dashboard.run_dau_dashboard(spark, SF_SMALL, run=run, trigger=AVAILABLE_NOW, stream_dir=folder, lateness="3650 days")
        logs = fx._logs_of(t.events.where((F.col("event_id") % 6 <= i) & (F.col("event_type") == "view")))
        dated = logs.withColumn("logdate", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))
        first = dated.groupBy("mid", "logdate").agg(F.min("ts").alias("ts"))
        want = first.groupBy("logdate", F.date_format(F.timestamp_millis("ts"), "HH").alias("loghour")).count()
        got = rows(dashboard.read_dau_dashboard(spark, run))
        assert got == rows(want)
        if seen is not None:
            now = {r[:2]: r[2] for r in got}
            moved += sum(now.get(k, 0) < n for k, n in seen.items())
        seen = {r[:2]: r[2] for r in got}
    assert moved > 0  # some devices were taken back from an hour
    assert len(rows(dashboard.read_dau_dashboard(spark, run, catalog.DAU_DATE))) > 0


def versions_of(spark, data):
    return spark.createDataFrame(data, "id string, s long, v int").select("id", F.timestamp_seconds("s").alias("since"), "v")


def test_asof_join_against_search(spark):
    random.seed(5)
    known = [(random.choice("abcd"), random.randrange(10_000), n) for n in range(60)] + [("hot", t, t) for t in range(0, 10_000, 7)]
    asked = [(random.choice(["a", "b", "c", "d", "none", "hot", None]), random.randrange(-50, 12_000), n) for n in range(300)]
    # Equal times: the larger version counts.
    known += [("a", 500, 900), ("a", 500, 901)]
    asked += [("a", 500, 1000), ("a", 499, 1001)]
    left = spark.createDataFrame(asked, "id string, s long, n int").select("id", F.timestamp_seconds("s").alias("at"), "n", F.lit(1).alias("version_x"))
    got = {r["n"]: r["version"]["v"] if r["version"] else None
           for r in asof_join(left, versions_of(spark, known), "id", "at", "since", bucket_seconds=600).collect()}
    by = {}
    for i, s, v in sorted(known):
        by.setdefault(i, []).append((s, v))
    want = {}
    for i, s, n in asked:
        place = bisect.bisect_right(by.get(i, []), (s, 1 << 40))
        want[n] = by[i][place - 1][1] if i in by and place else None
    assert got == want


def test_asof_join_of_nulls_and_repeated_rows(spark):
    left = spark.createDataFrame([("a", 5), ("a", 5), ("a", None), (None, 5)], "id string, s long").select(
        "id", F.timestamp_seconds("s").alias("at"))
    known = versions_of(spark, [("a", 1, 1), (None, 1, 2), ("a", None, 3)])
    out = asof_join(left, known, "id", "at", "since")
    assert out.columns == ["id", "at", "version"]
    got = Counter((r["id"], r["at"] is None, r["version"]["v"] if r["version"] else None) for r in out.collect())
    assert got == {("a", False, 1): 2, ("a", True, None): 1, (None, False, None): 1}
    assert asof_join(left, known.limit(0), "id", "at", "since").where("version is not null").count() == 0


def test_a_user_change_reaches_later_sales_only(spark):
    t = Tables(spark, SF_SMALL)
    history = fx.v_user_history(t)
    changed = history.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("id"))).where("n = 3").select("id", "valid_from", "user_level")
    user = sorted(changed.where("id = '1'").collect(), key=lambda r: r["valid_from"])
    assert [r["user_level"].split()[0] == "vip" for r in user] == [False, False, True]
    sales = spark.createDataFrame([("1", d) for d in ("1980-01-01", "1993-12-31", "1995-12-31", "1999-01-01")], "user_id string, day string")
    sales = sales.select("user_id", F.to_timestamp("day").alias("at"))
    out = asof_join(sales, history.withColumnRenamed("id", "user_id"), "user_id", "at", "valid_from").orderBy("at").collect()
    assert [r["version"] and r["version"]["user_level"] for r in out] == [None, *[r["user_level"] for r in user]]
