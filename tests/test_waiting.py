"""Joins of streams keep between micro-batches only what still waits, in tables and not in a state store."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import sales, search, ttl_join
from tidewater.plans import catalog
from tidewater.session import scratch_path
from tidewater.sinks import postings
from tidewater.sources import fixtures as fx
from tidewater.sources.streams import table_stream
from tidewater.sources.tables import Tables
from tidewater.streaming import caches, jobs, outer_join
from tidewater.streaming.waiting import Marks, Waiting

from .conftest import SF_SMALL
from .test_streaming import AVAILABLE_NOW

ORDER = ("O", "t", "u", "1997-01-01")
LINE = ("l", "s", "n", 1.0, None, None, None, None)
T0 = 1_000_000


def write(spark, feed, records):
    o = "struct<order_status:string,create_time:string,user_id:string,dt:string>"
    d = ("struct<order_detail_id:string,sku_id:string,sku_name:string,sku_price:double,l_shipdate:timestamp,l_partkey:bigint,"
         "l_suppkey:bigint,l_quantity:double>")
    data = [(i, s, ORDER if side == "o" else None, LINE if side == "d" else None) for i, s, side in records]
    frame = spark.createDataFrame(data, f"order_id string, s long, o {o}, d {d}")
    frame.select("order_id", F.timestamp_seconds("s").alias("ts"), "o", "d").coalesce(1).write.mode("append").parquet(feed)


@pytest.mark.parametrize("job", [outer_join.run_outer_join, caches.run_ttl_join])
def test_a_backlog_leaves_no_state_behind(spark, job):
    feed = f"{scratch_path(spark, 'feed')}/feed"
    write(spark, feed, [(f"a{i}", T0 + i, side) for i in range(50) for side in "od"] + [("end", T0 + 90_000, "o")])
    _, run = job(spark, feed, trigger=AVAILABLE_NOW)
    assert not os.path.exists(f"{run.checkpoint}/state")
    waiting = Waiting(f"{run.table}-waiting")
    assert [r["order_id"] for r in waiting.rows(spark, waiting.last(spark), "rows").collect()] == ["end"]


def test_outer_join_over_batches_that_overlap(spark):
    """A row that has met one is not alone later; rows of earlier batches do not meet twice."""
    feed = f"{scratch_path(spark, 'feed')}/feed"
    write(spark, feed, [("a", T0, "d"), ("b", T0, "o"), ("c", T0 + 60, "o")])
    write(spark, feed, [("a", T0 + 60, "o"), ("b", T0 + 130, "d"), ("x", T0 + 300, "o")])
    write(spark, feed, [("x", T0 + 310, "d"), ("x", T0 + 320, "d"), ("y", T0 + 500, "d")])
    write(spark, feed, [("end", T0 + 90_000, "o")])
    _, run = outer_join.run_outer_join(spark, feed, trigger=AVAILABLE_NOW, max_files_per_trigger=1)
    got = sorted((r["status"], r["order_id"]) for r in outer_join.read_outer(spark, run).collect())
    assert got == [("line", "b"), ("line", "y"), ("matched", "a"), ("matched", "x"), ("matched", "x"), ("order", "b"), ("order", "c")]


def test_sessions_that_are_over_and_open_ones(spark):
    data = [("a", 0, None, (1,)), ("a", 100, None, (2,)), ("a", 200, (9,), None), ("b", 0, None, (3,)), ("b", 10, (8,), None)]
    rows = spark.createDataFrame(data, "order_id string, s int, o struct<n:int>, d struct<n:int>").select(
        "order_id", F.timestamp_seconds("s").alias("ts"), "o", "d")
    done = ttl_join.ttl_join(rows, 120, upto=150_000)
    assert [(r["order_id"], r["d"]["n"]) for r in done.collect()] == [("b", 3)]
    left = ttl_join.open_rows(rows, 150_000, 120)
    assert left.columns == rows.columns and left.where("order_id = 'a'").count() == left.count() == 3


def test_marks_take_the_slowest_side(spark):
    marks = Marks().advanced({"o": 1000, "d": None}, 10)
    assert marks.watermark is None
    marks = marks.advanced({"o": 900, "d": 500}, 10)
    assert (marks.watermark, marks.before) == (490, None) and marks.reached["o"] == 1000
    waiting = Waiting(scratch_path(spark, "waiting"))
    for n in range(4):
        waiting.keep(spark.range(n + 1), n, "rows")
        waiting.finish(spark, n, marks, ("rows",))
    assert waiting.last(spark) == 3 and waiting.marks(spark, 3) == marks and waiting.rows(spark, 3, "rows").count() == 4
    assert waiting.rows(spark, 0, "rows") is None and waiting.rows(spark, 2, "rows").count() == 3


def shuffles(df):
    """Shuffles of the plan; broadcasts are off so that it is that of large tables."""
    spark, key = df.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    return plan.count("Exchange hashpartitioning(")


@pytest.mark.parametrize("job", [jobs.run_order_join, lambda *a, **k: jobs.run_sale_upsert(*a[:2], catalog.AGE_ASOF, **k)])
def test_order_joins_leave_no_state_behind(spark, job):
    _, run = job(spark, SF_SMALL, trigger=AVAILABLE_NOW)
    assert not os.path.exists(f"{run.checkpoint}/state")


def test_order_join_in_pieces_equals_batch(spark, tmp_path):
    """Orders and lines in any order, so that pairs meet over batches, each once."""
    # Nothing is late within so long a time.
    join = jobs.OrderLines(SF_SMALL, Waiting(str(tmp_path / "waiting")), lateness="36500 days")
    for n, (table, part) in enumerate((("orders", 0), ("lineitem", 1), ("lineitem", 0), ("orders", 1))):
        raw = spark.read.parquet(f"{SF_SMALL}/{table}.parquet")
        key = "o_orderkey" if table == "orders" else "l_orderkey"
        half = raw.where(F.col(key) % 2 == part)
        name, cols = ("o", fx.ORDER_SOURCE) if table == "orders" else ("d", fx.LINE_SOURCE)
        none = getattr(Tables(spark, SF_SMALL), "lineitem" if name == "o" else "orders").limit(0).select(
            F.struct(*(fx.LINE_SOURCE if name == "o" else fx.ORDER_SOURCE)).alias("d" if name == "o" else "o"))
        batch = half.select(F.struct(*cols).alias(name)).unionByName(none, allowMissingColumns=True)
        for _ in range(2 if n == 2 else 1):  # a batch that is run again
            join.apply(batch, n, lambda pairs, n=n: pairs.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={n}")))
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = catalog.REGISTRY["order_detail_interval_join"].run(spark, SF_SMALL).select(*got.columns)
    assert rows_of(got) == rows_of(want) and len(rows_of(want)) > 100


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_slices_are_batches_of_several_files(spark):
    run = jobs.StreamRun.fresh(spark, "slices")
    orders = Tables(spark, SF_SMALL).orders.repartition(3)
    for folder in catalog._in_slices(spark, "orders", [orders.where("o_orderkey % 2 = 0"), orders]):
        assert len([f for f in os.listdir(f"{folder}/orders") if f.endswith(".parquet")]) >= 3
        q, run = jobs.run_order_table(spark, SF_SMALL, run=run, trigger=AVAILABLE_NOW, stream_dir=folder)
        assert len([p for p in q.recentProgress if p["numInputRows"]]) == 1


def test_batches_without_state_keep_the_sessions_partitions(spark):
    """More partitions than cores: a batch is shuffled to them, not to one a core."""
    n = spark.sparkContext.defaultParallelism + 5
    key, seen = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    stream = table_stream(spark, SF_SMALL, "orders")
    spark.conf.set(key, str(n))
    try:
        q = jobs._start(spark, stream.writeStream.trigger(**AVAILABLE_NOW).foreachBatch(
            lambda b, i: seen.append(b.sparkSession.conf.get(key))), stateful=False)
        q.awaitTermination()
    finally:
        spark.conf.set(key, before)
    assert seen == [str(n)] and spark.conf.get(key) == before


def test_documents_are_not_shuffled_again_after_the_order_join(spark):
    """One row a document from lines that were joined on the order id."""
    orders = spark.createDataFrame([("1", "O", "t", "u", "d", 5)], "id string, order_status string, create_time string, user_id string, create_date string, create_ts int")
    lines = spark.createDataFrame([("1-1", "1", "s", "n", "1.0", 5, 1), ("1-1", "1", "s2", "n2", "2.0", 5, 2)],
                                  "id string, order_id string, sku_id string, sku_name string, order_price string, arrival_ts int, v int")
    joined = sales.inner_join(orders, lines, extra=("v",))
    latest = sales.latest_per_doc(joined, ("v",))
    assert shuffles(latest) == shuffles(joined) == 2
    assert [(r["doc_id"], r["order_id"], r["sku_id"], r["v"]) for r in latest.collect()] == [("1_1-1", "1", "s2", 2)]


def test_an_answer_without_hits_has_its_total(spark):
    none = spark.createDataFrame([], "doc_id string, user_age int, user_gender string, score double")
    assert [tuple(r) for r in search.answer_parts(none, 1, 5).collect()] == [("total", 1, None, 0.0)]


def test_postings_of_a_large_batch_are_in_more_files(spark, monkeypatch):
    """The files of a term that all documents have grow in number with the batch, not in size."""
    monkeypatch.setattr(postings, "DOCS_A_FILE", 10)
    path = scratch_path(spark, "index")
    batch = spark.range(200).select(F.concat(F.lit("d"), "id").alias("doc_id"), F.lit("red red ring").alias("text"), F.lit(1).alias("version"))
    postings.append_documents(batch.unionByName(batch.where("doc_id = 'd7'")), path, 0)
    found = postings.postings(spark, path, ["red"])
    assert found.count() == 200 and {r["tf"] for r in found.where("doc_id <> 'd7'").collect()} == {2}
    assert spark.read.parquet(f"{path}/terms").where("term = 'red'").count() == 200
    assert postings._files(0) == postings.FILES_A_BUCKET and postings._files(201) == 21
    dealt = postings._dealt(batch.withColumn("bucket", F.lit(0)), "doc_id", 21)
    assert dealt.select("slot").distinct().count() == 21
