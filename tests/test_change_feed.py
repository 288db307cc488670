"""The change feed: fetches, offsets, growth while stopped, failures between sink and commit."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import ingest
from tidewater.session import scratch_path
from tidewater.sources import change_feed
from tidewater.sources import fixtures as fx
from tidewater.sources.tables import Tables
from tidewater.streaming import jobs

from .conftest import SF_SMALL
from .test_streaming import AVAILABLE_NOW, rows


def changes_of(spark, lo, hi):
    after = F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("none"), F.lit(None).cast("string"))
    return spark.range(lo, hi).select(
        F.lit("user_info").alias("table"), F.lit("ROWDATA").alias("entry_type"), F.lit("INSERT").alias("event_type"),
        F.col("id").alias("seq"), after.alias("after"))


def entries(reader, start, end):
    out = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            assert 0 < batch.num_rows <= reader.fetch_entries
            out.extend(batch.column(3).to_pylist())
    return sorted(out)


def test_fetches_and_offsets(spark):
    path = f"{scratch_path(spark, 'feed')}/feed"
    reader = change_feed.ChangeFeedReader({"path": path})
    assert reader.latestOffset() == reader.initialOffset()  # no feed yet
    assert change_feed.append_changes(changes_of(spark, 0, 1050).coalesce(1), path, file_entries=400) == 0
    first = reader.latestOffset()
    assert len(reader.partitions(reader.initialOffset(), first)) == 3
    assert entries(reader, reader.initialOffset(), first) == list(range(1050))
    assert change_feed.append_changes(changes_of(spark, 1050, 1300), path) == 1
    assert entries(reader, first, reader.latestOffset()) == list(range(1050, 1300))
    assert entries(reader, first, first) == []
    assert entries(change_feed.ChangeFeedReader({"path": f"file://{path}", "fetchEntries": "7"}), first, {"segment": 2}) == list(range(1050, 1300))


def test_an_unfinished_segment_is_never_read(spark):
    path = f"{scratch_path(spark, 'feed')}/feed"
    change_feed.append_changes(changes_of(spark, 0, 10), path)
    changes_of(spark, 10, 20).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/segment=1")
    reader = change_feed.ChangeFeedReader({"path": path})
    assert reader.latestOffset() == {"segment": 1}
    assert change_feed.append_changes(changes_of(spark, 20, 30), path) == 2
    assert reader.latestOffset() == {"segment": 3}
    assert entries(reader, reader.initialOffset(), {"segment": 3}) == [*range(10), *range(20, 30)]


def test_no_entry_is_lost_or_doubled_over_restarts(spark):
    all_changes = fx.v_cdc(Tables(spark, SF_SMALL))
    path = f"{scratch_path(spark, 'feed')}/feed"
    run = jobs.StreamRun.fresh(spark, "feed-run")
    calls = []

    def fails_once(batch_id):
        calls.append(batch_id)
        if calls == [0, 1]:
            # Entries that come before the restart belong to the next batch.
            change_feed.append_changes(part(2), path)
            raise RuntimeError("lost between sink and commit")

    def part(n):
        return all_changes.where(F.pmod(F.xxhash64("table", "seq"), F.lit(3)) == n)

    start = dict(run=run, trigger=AVAILABLE_NOW, after_write=fails_once)
    change_feed.append_changes(part(0), path)
    jobs.run_cdc_feed(spark, path, **start)
    change_feed.append_changes(part(1), path)
    with pytest.raises(Exception, match="lost between"):
        jobs.run_cdc_feed(spark, path, **start)
    jobs.run_cdc_feed(spark, path, **start)
    jobs.run_cdc_feed(spark, path, **start)
    assert calls[:3] == [0, 1, 1] and calls[3:] == [2]
    columns = ["table", "seq", "topic", "value"]
    want = ingest.route_changes(all_changes).select(*columns)
    assert rows(jobs.read_routed(spark, run).select(*columns)) == rows(want)
    one = jobs.read_routed(spark, run, ingest.TOPIC_USER_INFO)
    assert one.count() == want.where(F.col("topic") == ingest.TOPIC_USER_INFO).count() > 0
