"""Full outer join of the order and line streams that loses no row.

Every arrival leaves the job exactly as often as it is matched, or once: as part of a
``matched`` pair as soon as both rows are there, as an ``order`` or ``line`` without a match when
the watermark has passed its wait, or as ``late_order`` / ``late_line`` at once if it is older
than the watermark when it comes.  The engine's own outer stream join drops late
rows before anybody sees them, and a stateful processor is called for every order id (a
million ids take minutes), so each micro-batch is joined with the rows that still wait by
ordinary joins; those rows and the watermark are kept in tables (:mod:`tidewater.streaming.waiting`).

Which rows are late depends on how the input is cut into batches; that matched, unmatched and
late rows make up the input does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.alerts import duration_ms
from tidewater.operators.sales import JOIN_WAIT_SECONDS
from tidewater.session import prepare_streaming
from tidewater.sources.arrivals import feed_stream
from tidewater.streaming.jobs import JOIN_LATENESS, StreamRun, _finish, _start, _trigger
from tidewater.streaming.waiting import Waiting, read_finished

ORDER_FIELDS = ("order_status", "create_time", "user_id", "dt")
LINE_FIELDS = ("order_detail_id", "sku_id", "sku_name", "sku_price")
MATCHED, ORDER, LINE, LATE_ORDER, LATE_LINE = "matched", "order", "line", "late_order", "late_line"

OUTPUT = ("status string, order_id string, order_status string, create_time string, user_id string, dt string, "
          "order_detail_id string, sku_id string, sku_name string, sku_price double")


def arrived(arrivals: DataFrame) -> DataFrame:
    """``arrivals`` (order_id, ts, o, d) with the time in milliseconds and the fields that the join gives."""
    o = F.when(F.col("o").isNotNull(), F.struct(*[F.col(f"o.{c}") for c in ORDER_FIELDS])).alias("o")
    d = F.when(F.col("o").isNull() & F.col("d").isNotNull(), F.struct(*[F.col(f"d.{c}") for c in LINE_FIELDS])).alias("d")
    return arrivals.select("order_id", F.unix_millis("ts").alias("ms"), o, d)


def outer_join(fresh: DataFrame, held: DataFrame | None, before: int | None, watermark: int | None,
               wait_seconds: int = JOIN_WAIT_SECONDS) -> DataFrame:
    """What a batch of rows (of :func:`arrived`) gives, with the rows ``held`` of earlier batches.

    ``before`` is the watermark when the batch comes, ``watermark`` the one after it.  A row is alone
    once, in the batch whose watermark passes its wait.  Rows without an order id, or without a time,
    match nothing but are not lost.
    """
    wait = wait_seconds * 1000
    fresh = fresh.where("o is not null or d is not null")  # no record: it only moves the watermark
    late = fresh.where(F.col("ms") < F.lit(before))
    on_time = fresh.where(F.col("ms").isNull() | F.lit(before).isNull() | (F.col("ms") >= F.lit(before)))
    rows = on_time.withColumn("held", F.lit(False))
    if held is not None:
        rows = rows.unionByName(held.withColumn("held", F.lit(True)))
    over = (F.col("ms") + wait < F.lit(watermark)) & (~F.col("held") | (F.col("ms") + wait >= F.lit(before)))
    rows = rows.withColumn("over", F.coalesce(over, F.lit(False)))
    keyed = rows.where("order_id is not null and ms is not null")
    orders = keyed.where("o is not null").select("order_id", F.col("ms").alias("o_ms"), F.col("held").alias("o_held"), "o", "over")
    lines = keyed.where("o is null").select(
        F.col("order_id").alias("d_id"), F.col("ms").alias("d_ms"), F.col("held").alias("d_held"), "d", F.col("over").alias("d_over"))
    near = (F.col("order_id") == F.col("d_id")) & (F.col("o_ms") >= F.col("d_ms") - wait) & (F.col("o_ms") <= F.col("d_ms") + wait)
    # As in sales.full_outer_join: a left join, whose hot ids AQE may split, and an anti join.
    left = lines.join(orders.drop("over"), near, "left")
    met = F.col("o_ms").isNotNull()
    matched = left.where(met & ~(F.col("o_held") & F.col("d_held")))
    lone_lines = left.where(~met & F.col("d_over"))
    lone_orders = orders.where("over").join(lines.select("d_id", "d_ms"), near, "left_anti")
    loose = rows.where("order_id is null or ms is null").where(F.col("over") | (F.col("ms").isNull() & ~F.col("held")))
    side = F.col("o").isNotNull()
    parts = [
        matched.select(F.lit(MATCHED).alias("status"), "order_id", "o", "d"),
        lone_lines.select(F.lit(LINE).alias("status"), F.col("d_id").alias("order_id"), "o", "d"),
        lone_orders.select(F.lit(ORDER).alias("status"), "order_id", "o"),
        loose.select(F.when(side, ORDER).otherwise(LINE).alias("status"), "order_id", "o", "d"),
        late.select(F.when(side, LATE_ORDER).otherwise(LATE_LINE).alias("status"), "order_id", "o", "d")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select("status", "order_id", "o.*", "d.*")


def still_waiting(fresh: DataFrame, held: DataFrame | None, before: int | None, watermark: int | None,
                  wait_seconds: int = JOIN_WAIT_SECONDS) -> DataFrame:
    """The rows that a later batch needs: those that wait, and those that may have met one that waits."""
    rows = fresh.where("(o is not null or d is not null) and ms is not null").where(
        F.lit(before).isNull() | (F.col("ms") >= F.lit(before)))
    rows = rows if held is None else rows.unionByName(held)
    return rows.where(F.lit(watermark).isNull() | (F.col("ms") + 2 * wait_seconds * 1000 >= F.lit(watermark)))


def _waiting(run: StreamRun) -> Waiting:
    return Waiting(f"{run.table}-waiting")


def run_outer_join(spark: SparkSession, feed: str, run: StreamRun | None = None, trigger: dict | None = None,
                   max_files_per_trigger: int | None = None, lateness: str = JOIN_LATENESS):
    """The outer join of the feed into ``run.table``, a folder a batch and status: ``status=late_line`` is the
    side table of late lines.  A replayed batch replaces its folder."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-outer-join")
    waiting = _waiting(run)

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        last = waiting.last(s, batch_id)
        marks, held = waiting.marks(s, last), waiting.rows(s, last, "rows")
        rows = arrived(batch)
        after = marks.advanced({"rows": rows.agg(F.max("ms")).first()[0]}, duration_ms(lateness))
        out = outer_join(rows, held, marks.watermark, after.watermark)
        out.write.mode("overwrite").partitionBy("status").parquet(f"{run.table}/batch={int(batch_id)}")
        waiting.keep(still_waiting(rows, held, marks.watermark, after.watermark), batch_id, "rows")
        waiting.finish(s, batch_id, after, ("rows",))

    arrivals = feed_stream(spark, feed, max_files_per_trigger)
    q = _start(spark, _trigger(arrivals.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_outer(spark: SparkSession, run: StreamRun) -> DataFrame:
    return read_finished(spark, run.table, _waiting(run), f"{OUTPUT}, batch long").select(
        "status", "order_id", "order_detail_id", "order_status", "create_time", "user_id", "dt", "sku_id", "sku_name", "sku_price")
