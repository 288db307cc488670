"""Compaction beside a running stream, and a job that fails between sink and commit."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans import catalog
from tidewater.session import scratch_path
from tidewater.sinks.generations import GenerationTable
from tidewater.streaming import jobs

from .conftest import SF_SMALL
from .test_streaming import AVAILABLE_NOW, rows

SCHEMA = "id string, seq int, v string"


def table_of(spark, batches):
    table = GenerationTable(scratch_path(spark, "generations"), ("id",), "seq")
    for n, batch in enumerate(batches):
        table.append(spark.createDataFrame(batch, SCHEMA), n)
    return table


BATCHES = [
    [("a", 1, "a1"), ("b", 9, "b9"), (None, 1, "n1")],
    [("a", 3, "a3"), ("a", 2, "a2"), ("c", 1, "c1")],
    [("b", 1, "later batch"), (None, 2, "n2")],
]
NOW = [("a", 3, "a3"), ("b", 1, "later batch"), ("c", 1, "c1"), (None, 2, "n2")]


def content(spark, table, upto=None):
    return sorted((tuple(r) for r in table.read(spark, upto).collect()), key=str)


def test_compaction_changes_no_answer(spark):
    table = table_of(spark, BATCHES)
    assert content(spark, table) == sorted(NOW, key=str)
    assert content(spark, table, 0) == sorted(BATCHES[0], key=str)
    table.compact(spark, 1)
    assert table.mark(spark) == 1 and content(spark, table) == sorted(NOW, key=str)
    table.compact(spark, 2)
    table.compact(spark, 1)  # an older mark is passed already
    table.drop_covered(spark)
    assert table.mark(spark) == 2 and content(spark, table) == sorted(NOW, key=str)


def test_rows_appended_while_compacting_stay(spark):
    table = table_of(spark, BATCHES)
    folded = table.read(spark, 1)
    # The compaction has read its batches; a batch arrives before it is published, and one is replayed.
    table.append(spark.createDataFrame([("d", 1, "d1"), ("a", 0, "a0")], SCHEMA), 3)
    folded.write.parquet(f"{table.path}/generations/upto=1")
    table.append(spark.createDataFrame(BATCHES[2], SCHEMA), 2)
    want = sorted([("a", 0, "a0"), ("d", 1, "d1"), *[r for r in NOW if r[0] != "a"]], key=str)
    assert content(spark, table) == want
    table.compact(spark, 3)
    table.drop_covered(spark)
    assert content(spark, table) == want


def test_an_unfinished_generation_or_batch_does_not_count(spark):
    table = table_of(spark, BATCHES)
    spark.createDataFrame([("x", 1, "half")], SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.path}/generations/upto=2")
    spark.createDataFrame([("y", 1, "half")], SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.path}/batches/batch=3")
    assert table.mark(spark) == -1 and content(spark, table) == sorted(NOW, key=str)
    with pytest.raises(ValueError):
        GenerationTable(scratch_path(spark, "none"), ("id",), "seq").read(spark)


def test_a_job_that_fails_before_its_commit_is_exact_after_the_restart(spark):
    folder = scratch_path(spark, "orders")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for i in range(3):
        orders.where(F.col("o_orderkey") % 3 == i).coalesce(1).write.mode("append").parquet(f"{folder}/orders")
    run = jobs.StreamRun.fresh(spark, "restart")
    table = jobs.order_table(run)
    calls = []

    def fails_once(batch_id):
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("lost between sink and commit")

    start = dict(run=run, trigger=AVAILABLE_NOW, max_files_per_trigger=1, stream_dir=folder)
    with pytest.raises(Exception, match="lost between"):
        jobs.run_order_table(spark, SF_SMALL, after_write=fails_once, **start)
    assert calls == [0, 1]
    jobs.run_order_table(spark, SF_SMALL, after_write=fails_once, **start)
    assert calls == [0, 1, 1, 2]
    # Every order once in the batches as they lie there, without a dedup.
    stored = spark.read.parquet(f"{table.path}/batches").groupBy("batch").count().collect()
    assert sum(r["count"] for r in stored) == orders.count() and len(stored) == 3
    want = catalog.REGISTRY["order_enriched"].run(spark, SF_SMALL)
    assert rows(table.read(spark).select(*want.columns)) == rows(want)
