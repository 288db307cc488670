"""Merge-on-read keyed table: the streaming sinks' write path.

A micro-batch appends its rows, each carrying a version; nothing existing is
read or rewritten, so a batch costs O(batch) however large the table grows.
Readers resolve the newest row per key with a grouped ``max_by`` (partial
aggregation after partition pruning).  ``compact`` folds a partition's
versions into one row per key with a copy-on-write rewrite, off the streaming path (e.g. for closed days).

A replayed micro-batch appends rows with the same versions again; readers
pick one of identical rows, so replays are harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.ingest import latest_per_key
from tidewater.plans.strategy import DEFAULT_BROADCAST_ROWS
from tidewater.session import checkpoint_root, scratch_path
from tidewater.sinks.upsert import _any_null, _exists, write_partitions


def append_versions(batch: DataFrame, path: str, partition_col: str) -> None:
    """Append one batch (already carrying its version column).

    One write job over the batch as it is partitioned: every task writes its
    own files, so a batch's write is as parallel as the batch itself and no
    extra pass re-executes the micro-batch's plan.  The small files this
    leaves are folded by :func:`compact`.
    """
    batch.write.mode("append").option("compression", "zstd").partitionBy(partition_col).parquet(path)


def read_latest(spark: SparkSession, path: str, keys: list[str], version: str, keep: str = "max",
                where=None, null_is_key: bool = False, columns=None) -> DataFrame:
    """The table as of now: newest (``keep="min"``: oldest) row per key.

    ``where`` (a Column on the partition column) prunes partitions before
    the dedup.  Rows with a null key are kept, equal ones once; with
    ``null_is_key`` null is a key value like any other (an unknown device).  ``columns``: those of
    the result (all), keys among them; the version crosses the shuffle once more if it is one.
    """
    table = spark.read.parquet(path)
    if where is not None:
        table = table.where(where)
    columns = list(columns or table.columns)
    if null_is_key:
        return latest_per_key(table, keys, version, keep, columns).select(*columns)
    keyed = table.where(~_any_null(keys))
    resolved = latest_per_key(keyed, keys, version, keep, columns).select(*columns)
    return resolved.unionByName(table.where(_any_null(keys)).distinct().select(*columns))


def latest_if_repeated(table: DataFrame, keys: list[str], version: Column, columns, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Newest row per key (no null in it) of a table whose keys seldom have a second row.

    Rows are first counted by an 8-byte hash of their key; only rows of a hash that comes again
    cross a shuffle whole, the others are their key's only row.  With more than ``max_rows`` such hashes
    all rows are grouped.
    """
    spark, mark, columns = table.sparkSession, F.xxhash64(*keys), list(columns)
    again = table.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_mark")
    path = f"{scratch_path(spark, 'repeated')}/marks"
    again.write.parquet(path)
    again = spark.read.parquet(path)
    if again.count() > max_rows:
        return latest_per_key(table, keys, version, columns=columns).select(*columns)
    met, marks = mark == F.col("_mark"), F.broadcast(again)
    once = table.join(marks, met, "left_anti").select(*columns)
    return once.unionByName(latest_per_key(table.join(marks, met, "left_semi"), keys, version, columns=columns).select(*columns))


def compact(spark: SparkSession, path: str, keys: list[str], version: str, partition_col: str,
            keep: str = "max", partitions: list[str] | None = None) -> None:
    """Rewrite partitions (all, or the listed ones) with one row per key.

    For closed partitions: files that a stream appends to a partition while it is
    compacted would be replaced as well.
    """
    if not _exists(spark, path):
        return
    table = spark.read.parquet(path)
    if partitions is not None:
        table = table.where(F.col(partition_col).cast("string").isin([str(p) for p in partitions]))
    # The resolved rows replace the partitions they come from (dynamic overwrite);
    # nothing is merged with the existing files again.  Rows with a null key have no
    # identity: equal ones (a replayed batch) are kept once.  The rows are persisted
    # first: the write replaces the files that they are read from.
    resolved = latest_per_key(table.where(~_any_null(keys)), keys, version, keep).select(*table.columns)
    rows = resolved.unionByName(table.where(_any_null(keys)).distinct())
    checkpoint_root(spark)
    write_partitions(rows.checkpoint(eager=True), path, partition_col)
