"""Dashboard tables that are kept current: devices a day and hour, order amounts a day and hour, new devices a day.

Each micro-batch changes the tables by its difference (:mod:`tidewater.sinks.rollup`), so
a dashboard that asks every few seconds reads a few rows and nothing is recomputed.  A device
whose earlier start arrives late moves to that start's hour; an order that is
written again moves its amount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import dau as dau_ops
from tidewater.operators import gmv as gmv_ops
from tidewater.session import prepare_streaming
from tidewater.sinks.first_seen import FirstSeen
from tidewater.sinks.rollup import Rollup
from tidewater.sources import fixtures as fx
from tidewater.sources.streams import StreamTables
from tidewater.streaming.jobs import DAU_LATENESS, StreamRun, _finish, _start, _trigger, dau_stream


def dau_rollup(run: StreamRun) -> Rollup:
    """Devices by the hour of their first start of the day."""
    return Rollup(run.table, ("mid", "logdate"), ("logdate", "loghour"), ("devices",), "logdate")


def gmv_rollup(run: StreamRun) -> Rollup:
    """Amount and number of the orders by hour; cents as a decimal, so that what is taken back is exact."""
    return Rollup(run.table, ("id",), ("create_date", "create_hour"), ("amount", "orders"), "month")


def run_dau_dashboard(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
                      max_files_per_trigger: int | None = None, stream_dir: str | None = None, lateness: str = DAU_LATENESS):
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-dau-dashboard")
    t = StreamTables(spark, sf_dir, streamed=("events",), max_files_per_trigger=max_files_per_trigger, stream_dir=stream_dir)
    table = dau_rollup(run)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The state gives a device-day again when its first start becomes earlier.
        table.apply(batch.withColumn("devices", F.lit(1).cast("long")), batch_id)

    q = _start(spark, _trigger(dau_stream(fx.v_startup(t), lateness).writeStream.outputMode("update")
                 .option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger))
    return _finish(q, trigger), run


def read_dau_dashboard(spark: SparkSession, run: StreamRun, date: str | None = None) -> DataFrame:
    where = None if date is None else F.col("logdate") == date
    return dau_rollup(run).read(spark, where).select("logdate", "loghour", F.col("devices").alias("ct"))


def run_gmv_dashboard(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
                      max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-gmv-dashboard")
    t = StreamTables(spark, sf_dir, streamed=("orders",), max_files_per_trigger=max_files_per_trigger, stream_dir=stream_dir)
    orders = gmv_ops.enrich_orders(fx.v_order(t)).select(*gmv_ops.ORDER_COLUMNS)
    table = gmv_rollup(run)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(
            "id", "create_date", "create_hour", F.col("total_amount").cast("decimal(18,2)").alias("amount"),
            F.lit(1).cast("long").alias("orders"), F.substring("create_date", 1, 7).alias("month"))
        # An order may be in a batch twice: equal rows count once, of others the larger amount.
        newest = rows.groupBy("id").agg(F.max(F.struct("amount", "create_date", "create_hour", "orders", "month")).alias("x"))
        table.apply(newest.select("id", "x.*"), batch_id)

    q = _start(spark, _trigger(orders.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_gmv_dashboard(spark: SparkSession, run: StreamRun, date: str | None = None) -> DataFrame:
    where = None if date is None else F.col("create_date") == date
    return gmv_rollup(run).read(spark, where).select("create_date", "create_hour", "orders", F.col("amount").cast("double").alias("sum_amount"))


def run_new_devices(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
                    max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    """Each device's first day; no state in the stream, so starts may come in any order."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-new-devices")
    t = StreamTables(spark, sf_dir, streamed=("events",), max_files_per_trigger=max_files_per_trigger, stream_dir=stream_dir)
    starts = dau_ops.with_log_time(fx.v_startup(t)).select("mid", "logdate")
    table = FirstSeen(run.table)
    q = _start(spark, _trigger(starts.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(table.apply), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_new_devices(spark: SparkSession, run: StreamRun, date: str | None = None) -> DataFrame:
    out = FirstSeen(run.table).new_by_day(spark)
    out = out if date is None else out.where(F.col("logdate") == date)
    return out.select("logdate", F.col("n").alias("new_mid"))
