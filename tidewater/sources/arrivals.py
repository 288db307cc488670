"""Orders and order lines as one feed of arrivals, written once and read as a stream.

Deriving a line's arrival time needs its order; doing it while the feed is written
keeps the join of lines and orders out of every micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import prepare_session
from tidewater.sources import fixtures as fx
from tidewater.sources.tables import Tables

# Fixed values of the fixture mapping (shared with the oracle SQL).
REWRITE_MOD = 3          # orders whose key this divides are written again
REWRITE_SECONDS = 90     # ... so many seconds later


def order_arrivals(t: Tables, rewrites: bool = True) -> DataFrame:
    """order_id, ts, ``o`` (an order's write) and ``d`` (a line): one of the two is null.  With
    ``rewrites`` some orders are written twice."""
    orders = fx.v_order(t)
    details = fx.v_detail(t, orders)
    o = F.struct("order_status", "create_time", "user_id", F.col("create_date").alias("dt")).alias("o")
    writes = orders.select(F.col("id").alias("order_id"), F.col("create_ts").alias("ts"), o, "o_orderkey")
    if rewrites:
        again = writes.where(F.col("o_orderkey") % REWRITE_MOD == 0)
        writes = writes.unionByName(again.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {REWRITE_SECONDS} SECONDS")))
    d = F.struct(
        F.col("id").alias("order_detail_id"), "sku_id", "sku_name", F.col("order_price").cast("double").alias("sku_price"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity").alias("d")
    lines = details.select("order_id", F.col("arrival_ts").alias("ts"), d)
    return writes.drop("o_orderkey").unionByName(lines, allowMissingColumns=True)


def write_feed(arrivals: DataFrame, path: str, slices: int = 1, close: bool = True) -> None:
    """Append ``arrivals`` to the feed's folder in ``slices`` of about equal size and rising time, a
    write each, so a stream that reads files by age gets them in order.  ``close`` appends
    one more row, a day after the last: an order without lines that lets the watermark pass
    everything before it (a live feed goes on by itself)."""
    if slices == 1:
        arrivals.write.mode("append").option("compression", "zstd").parquet(path)
    else:
        at = F.col("ts").cast("double")
        cuts = arrivals.agg(F.percentile_approx(at, [i / slices for i in range(1, slices)], 10_000)).first()[0]
        bounds = [float("-inf"), *cuts, float("inf")]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            arrivals.where((at > lo) & (at <= hi)).coalesce(1).write.mode("append").parquet(path)
    if close:
        spark = arrivals.sparkSession
        last = spark.read.parquet(path).agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
        row = last.where("ts is not null").select(F.lit("").alias("order_id"), "ts", *[
            F.lit(None).cast(arrivals.schema[c].dataType).alias(c) for c in arrivals.columns if c not in ("order_id", "ts")])
        row.select(*arrivals.columns).coalesce(1).write.mode("append").parquet(path)


def feed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The feed as a stream, its files in the order in which they were written."""
    prepare_session(spark)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
