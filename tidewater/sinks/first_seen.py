"""First day of every key (device), kept current over micro-batches.

``firsts/bucket=b/batch=n`` holds (key, day) of keys that batch ``n`` made known or moved to an
earlier day; a key's first day is its least one.  ``changes/batch=n`` holds what the
batch adds to each day's number of new keys: one more where a key is new, one less on the day that it
leaves.  A day's number is a sum over a few rows, without reading the history of keys.

``filters/bucket=b/batch=n`` holds Bloom filter pages of the batch's new keys: bitmaps of 32,768 bits, a key's
probes in one page.  A key that the filter does not have is new without a look-up, and only
buckets that some key of the batch may be in are read.

A batch looks at earlier batches only and replaces what it wrote itself, so a replay changes nothing.
``fold`` merges finished batches: least days, united pages, summed changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_root
from tidewater.sinks.generations import _fs, _numbers
from tidewater.sinks.upsert import _exists

# Bits of a page: the size of the engine's bitmaps.
PAGE_BITS = 32_768
PROBES = 4


@dataclass(frozen=True)
class FirstSeen:
    """A page serves some 2,700 keys at 12 bits a key, so ``buckets * pages`` should be the number of
    keys over 2,700; with more keys the filter lets more of them through to the look-up, and
    the answer stays the same.  A null key is a key like any other; rows without a day are left out."""

    path: str
    key: str = "mid"
    day: str = "logdate"
    buckets: int = 64
    pages: int = 16

    def _placed(self, keys: DataFrame) -> DataFrame:
        place = F.xxhash64(F.col(self.key), F.lit("place"))
        probes = F.array(*[F.pmod(F.xxhash64(F.col(self.key), F.lit(i)), F.lit(PAGE_BITS)) for i in range(PROBES)])
        return keys.select(
            self.key, self.day, F.pmod(place, F.lit(self.buckets)).cast("int").alias("bucket"),
            F.pmod(F.shiftrightunsigned(place, 32), F.lit(self.pages)).cast("int").alias("page"), probes.alias("probes"))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in a batch of rows with a key and a day, any number of rows a key."""
        spark = batch.sparkSession
        least = batch.where(F.col(self.day).isNotNull()).groupBy(self.key).agg(F.min(self.day).alias(self.day))
        keys = self._placed(least).persist()
        changed = None
        try:
            if keys.isEmpty():
                return
            changed = self._changed(spark, keys, int(batch_id)).persist()
            numbered = changed.withColumn("batch", F.lit(int(batch_id)))
            _write(numbered.select(self.key, self.day, "bucket", "batch"), f"{self.path}/firsts")
            new = numbered.where("old_day is null").select("bucket", "batch", "page", F.explode("probes").alias("at"))
            _write(new.groupBy("bucket", "batch", "page").agg(F.bitmap_construct_agg("at").alias("bits")), f"{self.path}/filters")
            moved = changed.where("old_day is not null").select(F.col("old_day").alias(self.day), F.lit(-1).alias("n"))
            changes = changed.select(self.day, F.lit(1).alias("n")).unionByName(moved)
            changes.groupBy(self.day).agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/changes/batch={int(batch_id)}")
        finally:
            keys.unpersist()
            if changed is not None:
                changed.unpersist()

    def _changed(self, spark: SparkSession, keys: DataFrame, batch_id: int) -> DataFrame:
        """The batch's keys that are new or come earlier than known, with the day known so far."""
        if not _exists(spark, f"{self.path}/firsts"):
            return keys.withColumn("old_day", F.lit(None).cast(keys.schema[self.day].dataType))
        asked = self._maybe_known(spark, keys, batch_id)
        # At most one number a bucket.
        buckets = [r[0] for r in asked.where("maybe").select("bucket").distinct().collect()]
        known = spark.read.parquet(f"{self.path}/firsts").where(F.col("bucket").isin(buckets) & (F.col("batch") < batch_id))
        known = known.select(F.col("bucket").alias("_bucket"), F.col(self.key).alias("_key"), F.col(self.day).alias("_day"))
        same = F.col("maybe") & (F.col("bucket") == F.col("_bucket")) & F.col(self.key).eqNullSafe(F.col("_key"))
        met = asked.join(known, same, "left")
        old = met.groupBy(self.key, self.day, "bucket", "page", "probes").agg(F.min("_day").alias("old_day"))
        return old.where(F.col("old_day").isNull() | (F.col(self.day) < F.col("old_day")))

    def _maybe_known(self, spark: SparkSession, keys: DataFrame, batch_id: int) -> DataFrame:
        """``keys`` with ``maybe``: whether the filter of earlier batches has the key."""
        pages = spark.read.parquet(f"{self.path}/filters").where(F.col("batch") < batch_id)
        whole = pages.groupBy("bucket", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
        held = F.forall("probes", lambda at: _bit(F.col("bits"), at))
        return keys.join(whole, ["bucket", "page"], "left").withColumn("maybe", F.coalesce(held, F.lit(False))).drop("bits")

    def _mark(self, spark: SparkSession) -> int:
        return max(_numbers(spark, f"{self.path}/totals", "upto", True), default=-1)

    def new_by_day(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """(day, n): keys first seen on each day, as of now or of a batch not folded yet."""
        mark = self._mark(spark)
        changes = spark.read.parquet(f"{self.path}/changes").where(F.col("batch") > mark)
        if upto is not None:
            changes = changes.where(F.col("batch") <= int(upto))
        parts = changes.select(self.day, "n")
        if mark >= 0:
            parts = parts.unionByName(spark.read.parquet(f"{self.path}/totals/upto={mark}"))
        return parts.groupBy(self.day).agg(F.sum("n").alias("n")).where("n > 0")

    def first_days(self, spark: SparkSession) -> DataFrame:
        """(key, day) of all keys."""
        return spark.read.parquet(f"{self.path}/firsts").groupBy(self.key).agg(F.min(self.day).alias(self.day))

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Merges batches up to ``upto``, all committed by the stream, which may go on meanwhile.
        Least days and united pages may be merged twice, so a fold that died is run again; the
        folders it removes must not be read at the time."""
        if upto <= self._mark(spark):
            return
        checkpoint_root(spark)
        self.new_by_day(spark, upto).write.mode("overwrite").parquet(f"{self.path}/totals/upto={int(upto)}")
        merges = {"firsts": (["bucket", self.key], F.min(self.day).alias(self.day)),
                  "filters": (["bucket", "page"], F.bitmap_or_agg("bits").alias("bits"))}
        fs, hpath = _fs(spark, self.path)
        for folder, (by, merged) in merges.items():
            base = f"{self.path}/{folder}"
            rows = spark.read.parquet(base).where(F.col("batch") <= int(upto)).groupBy(*by).agg(merged)
            _write(rows.withColumn("batch", F.lit(int(upto))).checkpoint(eager=True), base)
            for b in _numbers(spark, base, "bucket", False):
                for n in _numbers(spark, f"{base}/bucket={b}", "batch", False):
                    if n < upto:
                        fs.delete(hpath(f"{base}/bucket={b}/batch={n}"), True)


def _bit(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` of a page is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int"))
    return byte.bitwiseAND(mask) != 0


def _write(rows: DataFrame, path: str) -> None:
    """A bucket's rows of a batch in one file; folders written by an earlier run of the batch are replaced."""
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "bucket", "batch").parquet(path)
