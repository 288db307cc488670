"""Metamorphic checks: streaming the input in several time-ordered files (one
micro-batch each) gives the batch answer."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import alerts, dau, sales
from tidewater.plans import catalog
from tidewater.session import scratch_path
from tidewater.sinks.versioned import append_versions, read_latest
from tidewater.sources import fixtures as fx
from tidewater.sources.tables import Tables
from tidewater.streaming import jobs

from .conftest import SF_SMALL

AVAILABLE_NOW = {"availableNow": True}
PIECES = 4


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def write_in_pieces(df, order_col, path, drop=()):
    """Append ``PIECES`` time-ordered files one after the other, so their
    modification times (the order a file stream picks them in) follow time.
    Test-size data only: the ranking window has no partition."""
    ranked = df.withColumn("_piece", F.ntile(PIECES).over(Window.orderBy(order_col))).persist()
    for i in range(1, PIECES + 1):
        piece = ranked.where(F.col("_piece") == i).drop("_piece", *drop)
        piece.coalesce(1).write.mode("append").parquet(path)
    ranked.unpersist()


@pytest.fixture(scope="module")
def split_dir(spark):
    """events, orders and lineitem of the small scale, each split into
    time-ordered files (arrival order)."""
    out = scratch_path(spark, "split-input")
    t = Tables(spark, SF_SMALL)
    write_in_pieces(t.events, "ts", f"{out}/events")
    write_in_pieces(t.orders, "o_orderdate", f"{out}/orders")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    li = t.lineitem
    lines = li.join(orders, li.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    write_in_pieces(lines, "o_orderdate", f"{out}/lineitem", drop=("o_orderdate",))
    return out


def test_stream_dau_in_pieces_equals_batch(spark, split_dir):
    q, run = jobs.run_dau(spark, SF_SMALL, trigger=AVAILABLE_NOW, max_files_per_trigger=1, stream_dir=split_dir)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2
    batch = dau.first_start_per_day(fx.v_startup(Tables(spark, SF_SMALL)))
    assert rows(jobs.read_dau(spark, run).select(*batch.columns)) == rows(batch)


def test_stream_alerts_in_pieces_equal_batch(spark, split_dir):
    q, run = jobs.run_alert_counts(spark, SF_SMALL, "2 days", "1 day", trigger=AVAILABLE_NOW,
                                   max_files_per_trigger=1, stream_dir=split_dir)
    events = fx.v_event(Tables(spark, SF_SMALL)).select("mid", "uid", "evid", "itemid", "ts")
    batch = alerts.coupon_alerts(events, "2 days", "1 day", min_accounts=1)
    got = jobs.read_alerts(spark, run, min_accounts=1)
    assert rows(got) == rows(batch) and len(rows(batch)) > 0


def test_stream_sale_upsert_in_pieces_equals_batch(spark, split_dir):
    q, run = jobs.run_sale_upsert(spark, SF_SMALL, catalog.AGE_ASOF, trigger=AVAILABLE_NOW,
                                  max_files_per_trigger=1, stream_dir=split_dir)
    t = Tables(spark, SF_SMALL)
    orders = fx.v_order(t)
    joined = sales.interval_join(orders, fx.v_detail(t, orders), extra=jobs.SALE_VERSION)
    enriched = sales.enrich_with_users(joined, fx.v_user(t), catalog.AGE_ASOF)
    batch = sales.latest_per_doc(enriched, jobs.SALE_VERSION + ("sku_price",)).select("doc_id", *sales.SALE_COLUMNS)
    assert rows(jobs.read_sale_table(spark, run)) == rows(batch)


def test_upsert_replay_of_a_stream_is_harmless(spark, split_dir):
    run = jobs.StreamRun.fresh(spark, "replay")
    jobs.run_dau(spark, SF_SMALL, run=run, trigger=AVAILABLE_NOW, max_files_per_trigger=1, stream_dir=split_dir)
    first = rows(jobs.read_dau(spark, run))
    # same checkpoint: nothing new to read, table unchanged
    jobs.run_dau(spark, SF_SMALL, run=run, trigger=AVAILABLE_NOW, max_files_per_trigger=1, stream_dir=split_dir)
    assert rows(jobs.read_dau(spark, run)) == first


def test_log_router_stream_routes_and_stamps(spark):
    import json

    from pyspark.sql import functions as F

    from tidewater.operators import ingest
    from tidewater.sources.streams import text_stream

    base = scratch_path(spark, "router")
    raw = fx.v_raw_log(Tables(spark, SF_SMALL))
    raw.select("line").coalesce(2).write.text(f"{base}/in")
    q = jobs.run_log_router(spark, text_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/ckpt",
                            received_ms=F.lit(1234), trigger=AVAILABLE_NOW)
    out = spark.read.schema("value string, topic string").text(f"{base}/out")
    counts = {r["topic"]: r["count"] for r in out.groupBy("topic").count().collect()}
    expected = {r["topic"]: r["count"] for r in ingest.route_logs(raw).groupBy("topic").count().collect()}
    assert counts == expected
    sample = json.loads(out.where(F.col("topic") == ingest.TOPIC_STARTUP).first()["value"])
    assert sample["type"] == "startup" and sample["ts"] == 1234


def test_cdc_router_stream_matches_batch(spark):
    from pyspark.sql import functions as F

    from tidewater.operators import ingest
    from tidewater.sources.streams import table_stream

    base = scratch_path(spark, "cdc")
    changes = fx.v_cdc(Tables(spark, SF_SMALL))
    changes.repartition(3).write.parquet(f"{base}/in/changes")
    stream = table_stream(spark, f"{base}/in", "changes", max_files_per_trigger=1)
    q = jobs.run_cdc_router(spark, stream, f"{base}/out", f"{base}/ckpt", trigger=AVAILABLE_NOW)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2
    got = spark.read.schema("value string, topic string").text(f"{base}/out")
    want = ingest.route_changes(changes).select("value", "topic")
    assert rows(got) == rows(want)


def test_seen_set_dau_stream_in_pieces_equals_batch(spark, split_dir):
    q, run = jobs.run_dau_seen_set(spark, SF_SMALL, trigger=AVAILABLE_NOW, max_files_per_trigger=1,
                                   stream_dir=split_dir)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2
    batch = dau.first_start_per_day(fx.v_startup(Tables(spark, SF_SMALL)))
    # time-ordered arrival: the first arrival is the earliest start
    assert rows(jobs.read_dau_seen_set(spark, run).select(*batch.columns)) == rows(batch)


def test_gmv_stream_in_small_batches_equals_batch(spark, tmp_path):
    """Orders of several files, a file per batch, one file replayed as a copy."""
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    again = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 5 = 0")
    again.coalesce(1).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    _, run = jobs.run_gmv(spark, SF_SMALL, trigger=AVAILABLE_NOW, max_files_per_trigger=1, stream_dir=str(tmp_path))
    want = catalog.REGISTRY["order_enriched"].run(spark, SF_SMALL)
    got = jobs.read_orders(spark, run).select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_alert_outcomes_of_many_batches_equal_batch(spark, split_dir):
    """A window's outcome is evaluated again whenever a batch touches it, also when
    a later click takes the alert back."""
    window, slide = "6 hours", "1 hour"
    _, run = jobs.run_alert_counts(spark, SF_SMALL, window, slide, trigger=AVAILABLE_NOW, max_files_per_trigger=1,
                                   lateness="3650 days", stream_dir=split_dir)
    events = fx.v_event(Tables(spark, SF_SMALL)).select("mid", "uid", "evid", "itemid", "ts")
    want = alerts.coupon_alerts(events, window, slide)
    assert rows(jobs.read_alerts(spark, run).select(*want.columns)) == rows(want)


def test_a_null_key_is_one_group_of_a_versioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for version in (1, 2):
        batch = spark.createDataFrame([(None, version, "d"), ("m", version, "d")], "mid string, v long, day string")
        append_versions(batch, path, "day")
    got = read_latest(spark, path, ["mid"], "v", null_is_key=True).collect()
    assert len(got) == 2 and {r["mid"]: r["v"] for r in got} == {None: 2, "m": 2}


def test_a_null_device_is_seen(spark):
    logs = spark.createDataFrame([(None, "d"), ("m", "d"), ("n", "d")], "mid string, logdate string")
    seen = logs.where("mid is null or mid = 'm'")
    assert rows(dau.drop_seen(logs, seen, null_is_key=True)) == [("n", "d")]
