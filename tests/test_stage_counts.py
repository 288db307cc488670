"""Counts of stages against recounts, over several batches and a resumed query."""

from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sources.tables import Tables
from tidewater.streaming import jobs, stage_counts

from .conftest import SF_SMALL
from .test_streaming import AVAILABLE_NOW


def test_counts_of_every_batch(spark):
    events = Tables(spark, SF_SMALL).events
    folder, path = scratch_path(spark, "events"), f"{scratch_path(spark, 'counts')}/table"
    run = jobs.StreamRun.fresh(spark, "counted")
    for i in range(2):
        for j in range(2):
            events.where(F.col("event_id") % 4 == 2 * i + j).coalesce(1).write.mode("append").parquet(f"{folder}/events")
        _, run, counts = stage_counts.run_counted_dau(
            spark, SF_SMALL, path, run=run, trigger=AVAILABLE_NOW, max_files_per_trigger=1, stream_dir=folder, lateness="3650 days")
    got = {}
    for r in counts.read().collect():
        got.setdefault(r["stage"], {})[r["batch"]] = r["rows"]
    sizes = [events.where(F.col("event_id") % 4 == n).count() for n in range(4)]
    assert [n for _, n in sorted(got["logs"].items()) if n] == sizes
    starts = [events.where((F.col("event_id") % 4 == n) & (F.col("event_type") == "view")).count() for n in range(4)]
    assert [n for _, n in sorted(got["starts"].items()) if n] == starts
    written = spark.read.parquet(run.table).count()
    assert sum(got["firsts"].values()) == written
