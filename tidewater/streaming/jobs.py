"""Streaming jobs: the reference's four DStream applications as Structured
Streaming queries.

Each job reads a stream, applies the same operators as the batch twin, and
writes with a checkpointed sink, so a restarted job resumes from its offsets
and state (executor loss only re-runs tasks).  Results land in tables under
the checkpoint root; readers query those tables.

* DAU: a stateful aggregation per device and UTC day keeps the first start
  (update mode, watermark bounds the state); each batch appends its updated
  rows to a table partitioned by day, and readers keep the earliest row per
  ``(mid, logdate)`` (merge-on-read, :mod:`tidewater.sinks.versioned`).
* GMV: orders are enriched (date, hour, masked phone) and appended to a table
  partitioned by order month, keyed by order id; totals per day and hour are
  queries over the table's newest rows.
* Alerts: per-pane aggregates ``(pane, mid, evid)`` run in the stream (update
  mode, watermark).  Each batch evaluates the alert rule again for the windows
  its panes belong to, and appends the outcome; readers take the newest outcome
  of each window.
* Sale detail: inner join of the streams of orders and lines within the wait
  bound (a watermark over both sides; each batch is joined with the rows of
  earlier ones that still wait, :mod:`tidewater.streaming.waiting`), left join
  to users, and versioned appends keyed by doc id into a table partitioned by
  order month.

A micro-batch writes only its own rows (O(batch), one write job); folding
versions (``versioned.compact``) is a separate, periodic job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import alerts as alert_ops
from tidewater.operators import dau as dau_ops
from tidewater.operators import gmv as gmv_ops
from tidewater.operators import ingest
from tidewater.operators import sales as sale_ops
from tidewater.session import prepare_streaming, scratch_path
from tidewater.sinks.generations import GenerationTable
from tidewater.sinks.upsert import _exists as _table_exists
from tidewater.sinks.versioned import append_versions, read_latest
from tidewater.sources import fixtures as fx
from tidewater.sources.change_feed import change_stream
from tidewater.sources.streams import BatchTables, StreamTables
from tidewater.sources.tables import Tables
from tidewater.streaming.waiting import Waiting, read_finished

# The reference's micro-batch interval (fixed value).
BATCH_INTERVAL = "5 seconds"
DAU_LATENESS = "1 day"
ALERT_LATENESS = "10 minutes"
JOIN_LATENESS = "2 minutes"
# Bound on the distinct days of one micro-batch listed on the driver to prune
# the seen-set read (beyond it the whole seen set is joined).
MAX_BATCH_DAYS = 1000


@dataclass
class StreamRun:
    """Where a job keeps its checkpoint and its output table."""

    checkpoint: str
    table: str
    window: str | None = None
    slide: str | None = None

    @classmethod
    def fresh(cls, spark: SparkSession, name: str) -> "StreamRun":
        prepare_streaming(spark)
        base = scratch_path(spark, name)
        return cls(checkpoint=f"{base}/_checkpoint", table=f"{base}/table")


def _trigger(writer, trigger: dict | None):
    trig = trigger or {"processingTime": BATCH_INTERVAL}
    return writer.trigger(**trig)


def _start(spark: SparkSession, writer, state_partitions: int | None = None, stateful: bool = True):
    """Start a stream with a deliberate number of state partitions.

    A stream without state (``stateful=False``) keeps the session's shuffle partitions: its batches
    are joined and grouped like any table, in partitions that fit a task.

    A stateful stream fixes its partition count at its first start (it is
    recorded in the checkpoint), taking it from ``spark.sql.shuffle.partitions``.
    The default is one partition per core of the cluster; the session setting
    is restored right after ``start()`` (the stream runs on a cloned session).
    """
    if not stateful:
        return writer.start()
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def _finish(query, trigger: dict | None):
    """With ``availableNow`` the query stops by itself after the backlog."""
    if trigger and trigger.get("availableNow"):
        query.awaitTermination()
    return query


# --- DAU ------------------------------------------------------------------------------

def dau_stream(startup_logs: DataFrame, lateness: str = DAU_LATENESS) -> DataFrame:
    """Earliest start per device and UTC day as a stateful aggregation."""
    dated = dau_ops.with_log_time(startup_logs).withColumn("event_ts", F.timestamp_millis("ts"))
    cols = [c for c in dau_ops.with_log_time(startup_logs).columns]
    rest = [c for c in cols if c not in ("mid", "logdate") and c not in dau_ops.FIRST_ORDER]
    first = F.min(F.struct(*dau_ops.FIRST_ORDER, *rest)).alias("_first")
    agg = (
        dated.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 day").alias("day_window"), "mid", "logdate")
        .agg(first)
    )
    return agg.select("mid", "logdate", *[F.col(f"_first.{c}").alias(c) for c in list(dau_ops.FIRST_ORDER) + rest])


def run_dau(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
            max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-dau")
    t = StreamTables(spark, sf_dir, streamed=("events",), max_files_per_trigger=max_files_per_trigger,
                     stream_dir=stream_dir)
    rows = dau_stream(fx.v_startup(t))

    def write(batch: DataFrame, batch_id: int) -> None:
        # Readers keep the earliest row per key by (ts, uid, log_id).
        ordered = batch.withColumn("_rank", F.struct(*[F.col(c) for c in dau_ops.FIRST_ORDER]))
        append_versions(ordered, run.table, "logdate")

    q = _start(spark, _trigger(rows.writeStream.outputMode("update").option("checkpointLocation", run.checkpoint)
                 .foreachBatch(write), trigger))
    return _finish(q, trigger), run


def read_dau(spark: SparkSession, run: StreamRun, where=None) -> DataFrame:
    # A yyyy-MM-dd folder name is read back as a DATE; the column is a string.
    table = read_latest(spark, run.table, ["mid", "logdate"], "_rank", keep="min", where=where, null_is_key=True)
    return table.withColumn("logdate", F.col("logdate").cast("string")).drop("_rank")


def run_dau_seen_set(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
                     max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    """The reference's DAU design without a state store: per micro-batch,
    the first start per device-day of the batch, anti-joined against the
    seen set (the DAU table itself, re-read for the batch's days only), is
    appended.  The first *arrival* of a device-day wins, as in the reference;
    a batch that fails is replayed from its offsets and its rows are then
    already seen, so replays append nothing twice."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-dau-seen")
    t = StreamTables(spark, sf_dir, streamed=("events",), max_files_per_trigger=max_files_per_trigger,
                     stream_dir=stream_dir)
    logs = fx.v_startup(t)

    def write(batch: DataFrame, batch_id: int) -> None:
        firsts = dau_ops.first_start_per_day(batch).persist()
        try:
            days = [r[0] for r in firsts.select("logdate").distinct().limit(MAX_BATCH_DAYS + 1).collect()]
            if not days:
                return
            fresh = firsts
            if _table_exists(batch.sparkSession, run.table):
                seen = batch.sparkSession.read.parquet(run.table).select(
                    "mid", F.col("logdate").cast("string").alias("logdate"))
                if len(days) <= MAX_BATCH_DAYS:
                    seen = seen.where(F.col("logdate").isin(days))
                fresh = dau_ops.drop_seen(firsts, seen, null_is_key=True)
            fresh.write.mode("append").partitionBy("logdate").parquet(run.table)
        finally:
            firsts.unpersist()

    q = _start(spark, _trigger(logs.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_dau_seen_set(spark: SparkSession, run: StreamRun) -> DataFrame:
    return spark.read.parquet(run.table).withColumn("logdate", F.col("logdate").cast("string"))


# --- GMV ------------------------------------------------------------------------------

def run_gmv(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
            max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    """Enriched orders into a table by month of ``create_date`` (a backlog of years
    would open a file per day and task).  The job is stateless: no
    watermark, so no late order is dropped; a repeated order keeps its newest row
    when read (:func:`read_orders`)."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-gmv")
    t = StreamTables(spark, sf_dir, streamed=("orders",), max_files_per_trigger=max_files_per_trigger,
                     stream_dir=stream_dir)
    orders = gmv_ops.enrich_orders(fx.v_order(t)).select(*gmv_ops.ORDER_COLUMNS)

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("_batch", F.lit(batch_id).cast("long")).withColumn("month", F.substring("create_date", 1, 7))
        append_versions(keyed, run.table, "month")

    q = _start(spark, _trigger(orders.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_orders(spark: SparkSession, run: StreamRun, date: str | None = None) -> DataFrame:
    """The newest row of every order, optionally of one day: its month's folder, then
    row groups by the date's statistics (an order's date never changes)."""
    where = None if date is None else (F.col("month") == date[:7]) & (F.col("create_date") == date)
    return read_latest(spark, run.table, ["id"], "_batch", where=where).select(*gmv_ops.ORDER_COLUMNS)


def order_table(run: StreamRun) -> GenerationTable:
    return GenerationTable(run.table, ("id",), "total_amount")


def run_order_table(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
                    max_files_per_trigger: int | None = None, stream_dir: str | None = None, after_write=None):
    """Enriched orders into a table that may be compacted while the stream goes on and holds each batch
    once, however often it was run (:mod:`tidewater.sinks.generations`).  ``after_write`` is called with a
    batch's number when its rows are written and its offsets are not yet committed."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-orders")
    t = StreamTables(spark, sf_dir, streamed=("orders",), max_files_per_trigger=max_files_per_trigger,
                     stream_dir=stream_dir)
    orders = gmv_ops.enrich_orders(fx.v_order(t)).select(*gmv_ops.ORDER_COLUMNS)
    table = order_table(run)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, batch_id)
        if after_write:
            after_write(batch_id)

    q = _start(spark, _trigger(orders.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


# --- coupon alerts ----------------------------------------------------------------------

def run_alert_counts(spark: SparkSession, sf_dir: str, window: str = alert_ops.WINDOW, slide: str = alert_ops.SLIDE,
                     run: StreamRun | None = None, trigger: dict | None = None, lateness: str = ALERT_LATENESS,
                     max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    """Keep per-pane aggregates of the event stream in a table, and the outcome
    of the alert rule for every window that a batch touches in another."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-alerts")
    t = StreamTables(spark, sf_dir, streamed=("events",), max_files_per_trigger=max_files_per_trigger,
                     stream_dir=stream_dir)
    events = alert_ops.with_event_time(fx.v_event(t).select("mid", "uid", "evid", "itemid", "ts"))
    panes = alert_ops.pane_counts(events.withWatermark("event_ts", lateness), window, slide)

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = (
            batch.withColumn("p_start", F.col("p.start"))
            .withColumn("day", F.date_format("p.start", "yyyy-MM-dd"))
            .withColumn("evid_key", F.coalesce("evid", F.lit("")))
            .withColumn("_batch", F.lit(batch_id).cast("long"))
        )
        keyed = keyed.persist()
        try:
            if keyed.isEmpty():
                return
            append_versions(keyed, run.table, "day")
            append_versions(outcomes(keyed).withColumn("_batch", F.lit(batch_id).cast("long")), _outcome_table(run), "day")
        finally:
            keyed.unpersist()

    def outcomes(keyed: DataFrame) -> DataFrame:
        """The alert, or nulls, of every window with a pane in the batch.  The panes
        of those windows start less than a window before or after the batch's."""
        touched = alert_ops.touched_windows(keyed, window, slide)
        reach = F.expr(f"INTERVAL {alert_ops.duration_ms(window) // 1000} SECONDS")
        span = keyed.agg((F.min("p_start") - reach).alias("lo"), (F.max("p_start") + reach).alias("hi"))
        lo, hi = span.first()
        days = (F.col("day") >= F.lit(lo).cast("date")) & (F.col("day") <= F.lit(hi).cast("date"))
        devices = touched.select(F.col("mid").alias("_mid")).distinct()
        near = _latest_panes(keyed.sparkSession, run, days & F.col("p_start").between(F.lit(lo), F.lit(hi)))
        near = near.join(devices, F.col("mid").eqNullSafe(F.col("_mid")), "left_semi")
        fired = alert_ops.alerts_from_panes(near, window, slide)
        return _with_day(touched, fired)

    q = _start(spark, _trigger(panes.writeStream.outputMode("update").option("checkpointLocation", run.checkpoint)
                 .foreachBatch(write), trigger))
    run.window, run.slide = window, slide
    return _finish(q, trigger), run


def _outcome_table(run: StreamRun) -> str:
    return f"{run.table}-alerts"


def _latest_panes(spark: SparkSession, run: StreamRun, where=None) -> DataFrame:
    return read_latest(spark, run.table, ["p_start", "mid", "evid_key"], "_batch", where=where, null_is_key=True).select(
        "p", "mid", "evid", "n", "uids", "items")


def _with_day(touched: DataFrame, fired: DataFrame) -> DataFrame:
    f = fired.withColumnsRenamed({"window_start": "_start", "mid": "_mid"})
    joined = touched.join(f, (F.col("window_start") == F.col("_start")) & F.col("mid").eqNullSafe(F.col("_mid")), "left")
    return joined.drop("_start", "_mid").withColumn("day", F.substring("window_start", 1, 10))


def read_alerts(spark: SparkSession, run: StreamRun, min_accounts: int | None = None, where=None) -> DataFrame:
    """Alerts of the windows as of now; ``where`` (on ``day``, the window's start)
    prunes folders.  Another threshold than the job's is evaluated from all panes."""
    if min_accounts is not None:
        return alert_ops.alerts_from_panes(_latest_panes(spark, run), run.window, run.slide, min_accounts)
    table = read_latest(spark, _outcome_table(run), ["window_start", "mid"], "_batch", where=where, null_is_key=True)
    return table.where(F.col("ts").isNotNull()).select(
        "mid", "window_start", "window_end", "uids", "item_ids", "events", "ts")


def read_latest_alerts(spark: SparkSession, run: StreamRun) -> DataFrame:
    """One document a device and minute, the last alert wins."""
    return alert_ops.latest_alert_per_doc(read_alerts(spark, run))


# --- sale detail --------------------------------------------------------------------------

SALE_VERSION = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


def order_line_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None,
                      stream_dir: str | None = None) -> DataFrame:
    """Rows of the streams of orders and lines as they come: ``o`` or ``d``, the other is null."""
    t = StreamTables(spark, sf_dir, streamed=("orders", "lineitem"), max_files_per_trigger=max_files_per_trigger,
                     stream_dir=stream_dir)
    orders = t.orders.select(F.struct(*fx.ORDER_SOURCE).alias("o"))
    lines = t.lineitem.select(F.struct(*fx.LINE_SOURCE).alias("d"))
    return orders.unionByName(lines, allowMissingColumns=True)


@dataclass(frozen=True)
class OrderLines:
    """The join of orders and lines within the wait bound, a micro-batch at a time.

    A batch's rows are kept as they came for the next batch, and of older rows those within the wait
    of a row that would not be late then.  As in the engine's own join a row is late if it is not
    newer than the watermark that the batch before the last one left.
    """

    sf_dir: str
    waiting: Waiting
    wait_seconds: int = sale_ops.JOIN_WAIT_SECONDS
    lateness: str = JOIN_LATENESS

    def _sides(self, spark: SparkSession, number: int) -> tuple[DataFrame, DataFrame]:
        """Orders and lines of the rows that a batch brought."""
        static, rows = Tables(spark, self.sf_dir), self.waiting.rows(spark, number, "arrived")
        orders = BatchTables(static, orders=rows.where("o is not null").select("o.*"))
        lines = BatchTables(static, lineitem=rows.where("d is not null").select("d.*"))
        return fx.v_order(orders), fx.v_detail(lines, orders=fx.v_order(static))

    def _held(self, spark: SparkSession, last: int, number: int, late: int | None) -> tuple[DataFrame, DataFrame]:
        """Orders and lines of earlier batches that a row of this batch may meet; written once."""
        out = []
        for name, ts, fresh in zip(("orders", "lines"), ("create_ts", "arrival_ts"), self._sides(spark, last), strict=True):
            older = self.waiting.rows(spark, last, name)
            rows = fresh if older is None else fresh.unionByName(older)
            if late is not None:
                rows = rows.where(F.unix_millis(ts) + self.wait_seconds * 1000 >= late)
            self.waiting.keep(rows, number, name)
            out.append(self.waiting.rows(spark, number, name))
        return out[0], out[1]

    def apply(self, batch: DataFrame, number: int, write, extra=(), order_extra=(), placed=lambda orders: orders) -> None:
        """Takes in a batch of :func:`order_line_stream`; ``write`` gets its pairs.  ``placed`` adds the
        columns ``order_extra`` to the orders."""
        spark = batch.sparkSession
        last = self.waiting.last(spark, number)
        marks = self.waiting.marks(spark, last)
        self.waiting.keep(batch, number, "arrived")
        orders, lines = self._sides(spark, number)
        seen = {
            "orders": orders.agg(F.unix_millis(F.max("create_ts"))).first()[0],
            "lines": lines.agg(F.unix_millis(F.max("arrival_ts"))).first()[0]}
        if marks.before is not None:
            orders = orders.where(F.unix_millis("create_ts") > marks.before)
            lines = lines.where(F.unix_millis("arrival_ts") > marks.before)

        def pairs(o: DataFrame, d: DataFrame) -> DataFrame:
            return sale_ops.interval_join(placed(o), d, self.wait_seconds, extra, order_extra)

        if last is None:
            write(pairs(orders, lines))
        else:
            held_orders, held_lines = self._held(spark, last, number, marks.before)
            write(pairs(orders.unionByName(held_orders), lines).unionByName(pairs(orders, held_lines)))
        self.waiting.finish(spark, number, marks.advanced(seen, alert_ops.duration_ms(self.lateness)), ("arrived", "orders", "lines"))


def _order_lines(run: StreamRun, sf_dir: str) -> OrderLines:
    return OrderLines(sf_dir, Waiting(f"{run.table}-waiting"))


def run_order_join(spark: SparkSession, sf_dir: str, run: StreamRun | None = None, trigger: dict | None = None,
                   max_files_per_trigger: int | None = None, stream_dir: str | None = None):
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-order-join")
    rows = order_line_stream(spark, sf_dir, max_files_per_trigger, stream_dir)
    join = _order_lines(run, sf_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        join.apply(batch, batch_id, lambda pairs: pairs.write.mode("overwrite").parquet(f"{run.table}/batch={int(batch_id)}"))

    q = _start(spark, _trigger(rows.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_order_join(spark: SparkSession, run: StreamRun) -> DataFrame:
    return read_finished(spark, run.table, Waiting(f"{run.table}-waiting"))


def run_sale_upsert(spark: SparkSession, sf_dir: str, asof: str, run: StreamRun | None = None,
                    trigger: dict | None = None, max_files_per_trigger: int | None = None,
                    stream_dir: str | None = None):
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-sale-upsert")
    rows = order_line_stream(spark, sf_dir, max_files_per_trigger, stream_dir)
    join = _order_lines(run, sf_dir)

    def append(pairs: DataFrame) -> None:
        docs = (
            sale_ops.with_doc_id(pairs)
            .withColumn("_version", F.struct(*[F.col(c) for c in SALE_VERSION + ("sku_price",)]))
            .withColumn("dt_month", F.substring("dt", 1, 7))
        )
        # Month folders (the order day never changes for a document, so its
        # month does not either); a day query prunes to one folder and then
        # skips row groups by the dt statistics.
        append_versions(docs, run.table, "dt_month")

    def write(batch: DataFrame, batch_id: int) -> None:
        users = fx.v_user(Tables(batch.sparkSession, sf_dir))
        join.apply(batch, batch_id, append, SALE_VERSION, sale_ops.USER_COLUMNS,
                   lambda orders: sale_ops.with_user_fields(orders, users, asof))

    q = _start(spark, _trigger(rows.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_sale_table(spark: SparkSession, run: StreamRun, where=None) -> DataFrame:
    return read_latest(spark, run.table, ["doc_id"], "_version", where=where, columns=("doc_id", *sale_ops.SALE_COLUMNS))


# --- intake ---------------------------------------------------------------------------------

def run_log_router(spark: SparkSession, raw_lines: DataFrame, out_path: str, checkpoint: str,
                   received_ms=None, trigger: dict | None = None):
    """Stamp and route a stream of raw log lines into ``out_path/topic=…``.

    ``received_ms`` defaults to the micro-batch's processing time.
    """
    prepare_streaming(spark)
    stamped = raw_lines.withColumn(
        "received_ms", received_ms if received_ms is not None else F.unix_millis(F.current_timestamp())
    )
    routed = ingest.route_logs(stamped, line_col="value").select("topic", "value")
    q = _start(spark, _trigger(routed.writeStream.format("text").partitionBy("topic").option("path", out_path)
                 .option("checkpointLocation", checkpoint), trigger))
    return _finish(q, trigger)


def run_cdc_router(spark: SparkSession, changes: DataFrame, out_path: str, checkpoint: str,
                   trigger: dict | None = None):
    """Route a stream of change records (``table, entry_type, event_type,
    after``) to ``out_path/topic=…`` as JSON lines of the after-image; the
    source's ``maxFilesPerTrigger`` (or ``maxOffsetsPerTrigger`` on a bus)
    bounds a batch like the reference's fetch size."""
    prepare_streaming(spark)
    routed = ingest.route_changes(changes).select("topic", "value")
    q = _start(spark, _trigger(routed.writeStream.format("text").partitionBy("topic").option("path", out_path)
                 .option("checkpointLocation", checkpoint), trigger))
    return _finish(q, trigger)


ROUTED_SCHEMA = "`table` string, seq long, topic string, value string, batch long"


def run_cdc_feed(spark: SparkSession, feed: str, run: StreamRun | None = None, trigger: dict | None = None, after_write=None):
    """Route the changes of a feed (:mod:`tidewater.sources.change_feed`) into ``batch=n/topic=…`` of the
    run's table.  A batch that is run again after a failure reads the same entries and replaces
    its folder, so every entry is there once.  ``after_write`` is called with a batch's number once
    it is written, before its offsets are committed."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-cdc-feed")
    routed = ingest.route_changes(change_stream(spark, feed)).select("table", "seq", "topic", "value")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("topic").parquet(f"{run.table}/batch={int(batch_id)}")
        if after_write:
            after_write(int(batch_id))

    q = _start(spark, _trigger(routed.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger))
    return _finish(q, trigger), run


def read_routed(spark: SparkSession, run: StreamRun, topic: str | None = None) -> DataFrame:
    rows = spark.read.schema(ROUTED_SCHEMA).parquet(run.table)
    return rows if topic is None else rows.where(F.col("topic") == topic)
