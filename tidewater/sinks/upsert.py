"""Keyed upsert into a partitioned parquet table (the reference's id-replacing
index and its keyed wide-table upsert).

Only the partitions a batch touches are read, merged with the batch (newest
row per key wins) and rewritten with dynamic partition overwrite; untouched
partitions are left alone.  Re-applying the same batch gives the same table,
so a replayed micro-batch after a failure is harmless.  The partition column
must be immutable for a key (a key that moved partition would keep its old
copy).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.ingest import latest_per_key
from tidewater.session import checkpoint_root

def _any_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (a file-system check, no read attempt)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def write_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Replaces the partitions that ``df`` has rows of.  The REBALANCE hint brings a
    partition value's rows together and splits large ones by bytes."""
    (
        df.hint("rebalance", F.col(partition_col)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    )


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: list[str],
    version: str,
    partition_col: str,
    keep: str = "max",
) -> None:
    """Merge ``batch`` into the table at ``path``, newest ``version`` per key
    (``keep="min"``: the oldest).

    Rows whose key is null (documents without id) are kept beside; equal ones once,
    so a replayed batch changes nothing.
    The batch is persisted for the two passes over it (touched partitions,
    merge) so a micro-batch's input and state are not evaluated twice.
    """
    batch = batch.persist()
    try:
        _merge(spark, batch, path, keys, version, partition_col, keep)
    finally:
        batch.unpersist()


def _merge(spark, batch, path, keys, version, partition_col, keep):
    if batch.isEmpty():
        return  # an empty micro-batch changes nothing
    merged = batch
    if _exists(spark, path):
        # Only partitions that the batch touches are read: the semi join's small
        # side prunes them when the query runs.
        existing = spark.read.parquet(path).select(*batch.columns)
        touched = batch.select(F.col(partition_col).alias("_touched")).distinct()
        merged = existing.join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi").unionByName(batch)
    keyed = latest_per_key(merged.where(~_any_null(keys)), keys, version, keep).select(*batch.columns)
    # Rows without a key have no identity: equal ones (a replay) are kept once.
    result = keyed.unionByName(merged.where(_any_null(keys)).distinct())
    checkpoint_root(spark)
    write_partitions(result.checkpoint(eager=True), path, partition_col)
