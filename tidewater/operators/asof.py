"""As-of join: each row with the version of its key that was valid at the row's time.

The versions of a key and the rows that ask for them are cut by time into buckets.  Inside
(key, bucket) the last version before a row is a running ``last``; a row without one
in its bucket takes the last version of the key's earlier buckets, which are first reduced
to one version a (key, bucket).  So a key that holds a third of all rows is spread over its
buckets, no row is compared with all versions of its key, and the window that runs over the whole
of a key has one row a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 30 * 86_400


def asof_join(rows: DataFrame, versions: DataFrame, key: str, row_ts: str, version_ts: str,
              bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``rows`` with a struct ``version``: the columns of ``versions`` (but its key) of the newest version
    of ``key`` that is not newer than ``row_ts``; null where there is none, or the key or time is
    null.  Of versions of equal key and time the largest (by the other columns) counts."""
    values = F.struct(*[F.col(c) for c in versions.columns if c != key])
    bucket = lambda ts: F.floor(F.col(ts).cast("double") / bucket_seconds)
    asked = rows.select(
        F.col(key).alias("_key"), bucket(row_ts).alias("_bucket"), F.col(row_ts).alias("_ts"),
        F.struct(*[F.col(c) for c in rows.columns]).alias("_row"))
    known = versions.where(F.col(key).isNotNull() & F.col(version_ts).isNotNull()).select(
        F.col(key).alias("_key"), bucket(version_ts).alias("_bucket"), F.col(version_ts).alias("_ts"), values.alias("_version"))

    # Inside a bucket: a version comes before a row of the same time, the largest of equal ones last.
    both = known.unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy("_key", "_bucket").orderBy("_ts", F.col("_row").isNotNull(), "_version")
    near = both.withColumn("_near", F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    near = near.where(F.col("_row").isNotNull()).select("_key", "_bucket", "_row", "_near")

    # From earlier buckets: one version a bucket, carried on over the buckets that ask or answer.
    lasts = known.groupBy("_key", "_bucket").agg(F.max(F.struct("_ts", "_version")).alias("_last"))
    buckets = lasts.unionByName(asked.select("_key", "_bucket").distinct(), allowMissingColumns=True).groupBy("_key", "_bucket").agg(
        F.max("_last").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)["_version"]).where(
        F.col("_carried").isNotNull()).select("_key", "_bucket", "_carried")
    return near.join(carried, ["_key", "_bucket"], "left").select("_row.*", F.coalesce("_near", "_carried").alias("version"))
