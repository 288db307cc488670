"""Re-armed caches, the outer join that loses no row, and both over many slices."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.operators import ttl_join
from tidewater.plans import catalog
from tidewater.session import scratch_path
from tidewater.sources import arrivals as feeds
from tidewater.sources.tables import Tables
from tidewater.streaming import caches, outer_join

from .conftest import SF_SMALL
from .parity import compare, duck
from .test_streaming import AVAILABLE_NOW, rows

def feed_of(spark, records):
    """(order id, seconds, 'o' or 'd', number) as arrivals."""
    data = [(i, s, (n,) if side == "o" else None, (n,) if side == "d" else None) for i, s, side, n in records]
    return spark.createDataFrame(data, "order_id string, s int, o struct<n:int>, d struct<n:int>").select(
        "order_id", F.timestamp_seconds("s").alias("ts"), "o", "d")


def pairs_of(records, ttl):
    """The caches, row by row."""
    orders, lines, out = {}, {}, Counter()
    for i, s, side, n in sorted(records, key=lambda r: (r[1], r[2] == "d")):
        if i is None:
            continue
        waiting, until = lines.get(i, ([], -1))
        if s > until:
            waiting = []
        if side == "o":
            out.update((i, s * 1000, n, d) for d in waiting)
            orders[i] = (s, n)
        elif i in orders and s <= orders[i][0] + ttl:
            out[i, orders[i][0] * 1000, orders[i][1], n] += 1
        else:
            lines[i] = ([*waiting, n], s + ttl)
    return out


def got_pairs(df, ttl):
    joined = ttl_join.ttl_join(df, ttl)
    return Counter(tuple(r) for r in joined.select("order_id", "order_ms", "o.n", "d.n").collect())


def test_lines_keep_each_other_waiting(spark):
    chain = [("a", 0, "d", 1), ("a", 10, "d", 2), ("a", 20, "d", 3), ("a", 30, "o", 9)]
    assert got_pairs(feed_of(spark, chain), 10) == {("a", 30_000, 9, n): 1 for n in (1, 2, 3)}
    gap = [("a", 0, "d", 1), ("a", 11, "d", 2), ("a", 21, "o", 9)]
    assert got_pairs(feed_of(spark, gap), 10) == {("a", 21_000, 9, 2): 1}
    over = [("a", 0, "d", 1), ("a", 11, "o", 9), ("a", 22, "d", 2)]
    assert got_pairs(feed_of(spark, over), 10) == {}


def test_an_order_written_again_is_kept_longer(spark):
    rearmed = [("a", 0, "o", 1), ("a", 8, "o", 2), ("a", 18, "d", 5)]
    assert got_pairs(feed_of(spark, rearmed), 10) == {("a", 8000, 2, 5): 1}
    # Lines stay in their cache when an order has met them, and meet its next write.
    again = [("a", 0, "d", 5), ("a", 4, "o", 1), ("a", 9, "o", 2), ("a", 11, "o", 3)]
    assert got_pairs(feed_of(spark, again), 10) == {("a", 4000, 1, 5): 1, ("a", 9000, 2, 5): 1}


def test_same_time_and_null_ids(spark):
    both = [("a", 5, "d", 1), ("a", 5, "o", 2), (None, 5, "d", 1), (None, 5, "o", 1), ("b", 1, "d", 7), ("b", 1, "d", 7), ("b", 2, "o", 8)]
    assert got_pairs(feed_of(spark, both), 10) == {("a", 5000, 2, 1): 1, ("b", 2000, 8, 7): 2}
    assert got_pairs(feed_of(spark, both).limit(0), 10) == {}


def test_random_feeds_against_the_caches(spark):
    import random

    random.seed(4)
    records = [(random.choice("abcdefgh"), random.randrange(400), random.choice("ood"), n) for n in range(150)]
    records += [(random.choice("ijklmnop"), random.randrange(400), random.choice("odd"), n) for n in range(150)]
    # One order write a second, as two writes at once have no order.
    seen = set()
    records = [r for r in records if r[2] == "d" or ((r[0], r[1]) not in seen and not seen.add((r[0], r[1])))]
    want = pairs_of(records, 10)
    assert got_pairs(feed_of(spark, records), 10) == want and len(want) > 40


@pytest.mark.parametrize("slices", [1, 5, 30])
def test_ttl_join_over_slices_equals_sql(spark, slices):
    feed = f"{scratch_path(spark, 'feed')}/feed"
    feeds.write_feed(feeds.order_arrivals(Tables(spark, SF_SMALL)), feed, slices)
    q, run = caches.run_ttl_join(spark, feed, trigger=AVAILABLE_NOW, max_files_per_trigger=1 if slices > 1 else None)
    got = caches.read_pairs(spark, run)
    want = duck(SF_SMALL).sql(catalog.REGISTRY["stream_ttl_join"].sql)
    order = [want.columns.index(c) for c in got.columns]
    assert rows(got) == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_a_batch_writes_a_line_once(spark):
    feed = f"{scratch_path(spark, 'feed')}/feed"
    feeds.write_feed(feeds.order_arrivals(Tables(spark, SF_SMALL)), feed)
    _, run = caches.run_ttl_join(spark, feed, trigger=AVAILABLE_NOW)
    table = spark.read.parquet(run.table)
    assert table.count() == table.select("order_id", "order_detail_id").distinct().count() == caches.read_pairs(spark, run).count()
    # What follows from other columns is not written.
    assert not {"doc_id", "_version"} & set(table.columns)


def test_arrivals_cross_the_shuffle_as_they_are(spark):
    # In as many partitions as asked for, and not in lists of one row.
    joined = ttl_join.ttl_join(feed_of(spark, [("a", 0, "d", 1), ("a", 10, "o", 2)]), 10, partitions=3)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == 1 and "3), REPARTITION_BY_NUM" in plan
    assert "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):]
    assert joined.count() == 1


def outer_feed(spark, slices):
    feed = f"{scratch_path(spark, 'feed')}/feed"
    feeds.write_feed(feeds.order_arrivals(Tables(spark, SF_SMALL), rewrites=False), feed, slices)
    return feed


@pytest.mark.parametrize("slices", [1, 5])
def test_outer_join_loses_no_row(spark, slices):
    feed = outer_feed(spark, slices)
    arrived = spark.read.parquet(feed).where("order_id <> ''").select(
        "order_id", F.col("o").isNotNull().alias("is_order"), "d.order_detail_id", "d.sku_id").collect()
    late = spark.read.parquet(feed).where("pmod(xxhash64(order_id), 20) = 0 and order_id <> ''")
    late_rows = late.collect()
    _, run = outer_join.run_outer_join(spark, feed, trigger=AVAILABLE_NOW, max_files_per_trigger=1 if slices > 1 else None)
    first = outer_join.read_outer(spark, run).groupBy("status").count().collect()
    assert {r["status"] for r in first} == {"matched", "order", "line"}
    # The same rows once more, after the feed's end: all late, into the side table, by a resumed query.
    spark.createDataFrame(late_rows, late.schema).coalesce(1).write.mode("append").parquet(feed)
    _, run = outer_join.run_outer_join(spark, feed, run=run, trigger=AVAILABLE_NOW)
    out = outer_join.read_outer(spark, run)
    counts = {r["status"]: r["count"] for r in out.groupBy("status").count().collect()}
    assert counts["late_order"] == sum(r["o"] is not None for r in late_rows)
    assert counts["late_line"] == sum(r["d"] is not None for r in late_rows)
    # Each on-time row is in a pair or alone, never both.
    orders = sum(r["is_order"] for r in arrived)
    on_time = out.where("status in ('matched', 'order')").select("order_id").distinct().count()
    assert on_time == orders
    paired = {(r[0], r[1], r[2]) for r in out.where("status = 'matched'").select("order_id", "order_detail_id", "sku_id").collect()}
    alone = {(r[0], r[1], r[2]) for r in out.where("status = 'line'").select("order_id", "order_detail_id", "sku_id").collect()}
    assert not paired & alone
    lines = {(r["order_id"], r["order_detail_id"], r["sku_id"]) for r in arrived if not r["is_order"]}
    assert paired | alone == lines


def test_outer_join_of_literal_rows(spark):
    feed = f"{scratch_path(spark, 'feed')}/feed"
    schema = spark.read.parquet(outer_feed(spark, 1)).schema
    o, d = ("O", "t", "u", "1997-01-01"), ("l", "s", "n", 1.0, None, None, None, None)
    t0 = 1_000_000

    def write(records):
        data = [(i, s, o if side == "o" else None, d if side == "d" else None) for i, s, side in records]
        frame = spark.createDataFrame(data, f"order_id string, s long, o {schema['o'].dataType.simpleString()}, d {schema['d'].dataType.simpleString()}")
        frame.select("order_id", F.timestamp_seconds("s").alias("ts"), "o", "d").coalesce(1).write.mode("append").parquet(feed)

    write([("a", t0, "o"), ("b", t0, "d"), ("c", t0, "o"), (None, t0, "o"), (None, t0, "d")])
    write([("a", t0 + 120, "d"), ("a", t0 + 120, "d"), ("b", t0 + 121, "o"), ("z", t0 + 5000, "o")])
    write([("a", t0, "d"), ("c", t0 + 4880, "d"), ("z", t0 + 5100, "d")])
    write([("end", t0 + 90_000, "o")])
    _, run = outer_join.run_outer_join(spark, feed, trigger=AVAILABLE_NOW, max_files_per_trigger=1)
    got = Counter((r["status"], r["order_id"]) for r in outer_join.read_outer(spark, run).collect())
    assert got == {("matched", "a"): 2, ("line", "b"): 1, ("order", "b"): 1, ("order", "c"): 1, ("order", None): 1, ("line", None): 1,
                   ("late_line", "a"): 1, ("line", "c"): 1, ("matched", "z"): 1}


def test_outer_join_key_equals_sql(spark):
    out = compare(spark, catalog.REGISTRY["stream_outer_join"], SF_SMALL, duck(SF_SMALL))
    assert out["cols_match"] and out["types_match"] and out["values_match"], out
