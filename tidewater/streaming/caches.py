"""Sale detail over the feed of arrivals, with re-armed caches.

The stream's pairs (:func:`tidewater.operators.ttl_join.ttl_join`) are appended to
a table by month.  An order written again gives its pairs again: a batch writes a line's newest
pair only, and readers keep the newest of several batches.  Document id and version are derived from the
table's columns when it is read.  Only the rows of caches that still live are kept
between micro-batches (:mod:`tidewater.streaming.waiting`): the others never reach a state store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import doc_id
from tidewater.operators.alerts import duration_ms
from tidewater.operators.ingest import latest_per_key
from tidewater.operators.sales import JOIN_WAIT_SECONDS
from tidewater.operators.ttl_join import gap_ms, open_rows, ttl_join
from tidewater.session import prepare_streaming
from tidewater.sinks.versioned import append_versions, latest_if_repeated
from tidewater.sources.arrivals import feed_stream
from tidewater.streaming.jobs import JOIN_LATENESS, SALE_VERSION, StreamRun, _finish, _start, _trigger
from tidewater.streaming.waiting import Waiting

PAIR_COLUMNS = (
    "doc_id", "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "sku_name",
    "sku_price", "dt", "order_ms",
)
# More partitions than the session has, if a batch has more arrivals than that for each: a task sorts its arrivals in memory.
ROWS_A_TASK = 700_000


def sale_pairs(arrivals: DataFrame, ttl_seconds: int = JOIN_WAIT_SECONDS, upto: int | None = None,
               partitions: int | None = None) -> DataFrame:
    """The newest pair of every line (of caches that are over at ``upto``) as a sale-detail row without its document
    id, with the columns that order its versions.  An order's pairs are in one partition and not shuffled again."""
    pairs = ttl_join(arrivals, ttl_seconds, upto, partitions).select(
        "order_id", "order_ms", "o.order_status", "o.create_time", "o.user_id", "o.dt", "d.*")
    columns = (*PAIR_COLUMNS[1:], *SALE_VERSION)
    last = latest_per_key(pairs, ["order_id", "order_detail_id"], _version(), columns=columns)
    return last.select(*columns, F.substring("dt", 1, 7).alias("dt_month"))


def _version() -> Column:
    return F.struct("order_ms", *SALE_VERSION, "sku_price")


def run_ttl_join(spark: SparkSession, feed: str, run: StreamRun | None = None, trigger: dict | None = None,
                 max_files_per_trigger: int | None = None, lateness: str = JOIN_LATENESS):
    """Pairs of the feed at ``feed`` into ``run.table``."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-ttl-join")
    waiting = Waiting(f"{run.table}-waiting")

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        last = waiting.last(s, batch_id)
        marks, held = waiting.marks(s, last), waiting.rows(s, last, "rows")
        reached, count = batch.agg(F.unix_millis(F.max("ts")), F.count(F.lit(1))).first()
        after = marks.advanced({"rows": reached}, duration_ms(lateness))
        partitions = max(int(s.conf.get("spark.sql.shuffle.partitions")), -(-count // ROWS_A_TASK))
        rows = batch.where("order_id is not null and ts is not null")
        if marks.watermark is not None:
            # Older rows than any cache that may still live are late, as in a windowed aggregate.
            rows = rows.where(F.unix_millis("ts") + gap_ms(JOIN_WAIT_SECONDS) > marks.watermark)
        rows = rows if held is None else rows.unionByName(held)
        if after.watermark is None:
            waiting.keep(rows, batch_id, "rows")
        else:
            append_versions(sale_pairs(rows, upto=after.watermark, partitions=partitions), run.table, "dt_month")
            waiting.keep(open_rows(rows, after.watermark), batch_id, "rows")
        waiting.finish(s, batch_id, after, ("rows",))

    arrivals = feed_stream(spark, feed, max_files_per_trigger)
    q = _start(spark, _trigger(arrivals.writeStream.option("checkpointLocation", run.checkpoint).foreachBatch(write), trigger),
               stateful=False)
    return _finish(q, trigger), run


def read_pairs(spark: SparkSession, run: StreamRun, where=None) -> DataFrame:
    """One row a document, of its order's last write."""
    table = spark.read.parquet(run.table)
    if where is not None:
        table = table.where(where)
    docs = table.select(doc_id("_", "order_id", "order_detail_id").alias("doc_id"), "*")
    return latest_if_repeated(docs, ["doc_id"], _version(), PAIR_COLUMNS)
