"""Aggregates that are kept up to date, with retraction.

The dashboard asks for counts and sums by group every few seconds.  A
:class:`Rollup` keeps them beside the keyed rows they come from: a micro-batch of new or
changed rows is joined with the rows that it replaces (of the folders it touches only),
and the difference by group is appended: what a row adds to its new group, less what it
added to its old one.  A device whose earlier start arrives later moves from one hour to another;
an order written again changes its hour's amount by the difference.

A batch writes its rows and differences under its own number and looks at earlier
batches only, so a replayed batch replaces what it wrote and changes nothing.  Readers sum
the differences: rows in proportion to groups and batches, not to the data; :meth:`Rollup.fold` adds
those of many batches up to one row a group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import checkpoint_root
from tidewater.sinks.upsert import _exists

# Bound on a batch's folders listed on the driver to prune the earlier rows; beyond it all are joined.
MAX_FOLDERS = 1000


@dataclass(frozen=True)
class Rollup:
    """``measures`` (long or decimal columns, so sums are exact) of ``groups`` over the newest row of each key.

    ``folder`` is a string column of the rows that never changes for a key; the rows of a key are
    looked up in its folder.
    """

    path: str
    keys: tuple[str, ...]
    groups: tuple[str, ...]
    measures: tuple[str, ...]
    folder: str

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in a batch with one row a key: the key's row as of now."""
        spark = batch.sparkSession
        columns = list(dict.fromkeys((*self.keys, *self.groups, *self.measures, self.folder)))
        rows = batch.select(*columns).persist()
        try:
            if rows.isEmpty():
                return
            added = rows.select(*self.groups, *self.measures, F.lit(1).alias("rows"))
            old = self._replaced(spark, rows, batch_id)
            if old is not None:
                added = added.unionByName(old.select(
                    *self.groups, *[(-F.col(m)).alias(m) for m in self.measures], F.lit(-1).alias("rows")))
            changes = added.groupBy(*self.groups).agg(
                *[F.sum(m).alias(m) for m in self.measures], F.sum("rows").alias("rows"))
            changes.write.mode("overwrite").parquet(f"{self.path}/changes/batch={int(batch_id)}")
            # Inside a folder a batch's own, so that a replay overwrites it and a reader skips other folders.
            rows.withColumn("_batch", F.lit(int(batch_id))).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy(self.folder, "_batch").parquet(f"{self.path}/rows")
        finally:
            rows.unpersist()

    def _replaced(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """The rows of earlier batches that the batch's keys had."""
        if not _exists(spark, f"{self.path}/rows"):
            return None
        # The folder's name is read back as text, whatever it looks like.
        schema = T.StructType([*rows.schema.fields, T.StructField("_batch", T.IntegerType())])
        known = spark.read.schema(schema).parquet(f"{self.path}/rows").where(F.col("_batch") < int(batch_id))
        folders = [r[0] for r in rows.select(self.folder).distinct().limit(MAX_FOLDERS + 1).collect()]
        if len(folders) <= MAX_FOLDERS:
            known = known.where(F.col(self.folder).isin([f for f in folders if f is not None]) | (
                F.col(self.folder).isNull() if None in folders else F.lit(False)))
        wanted = rows.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        same = _all([F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        mine = known.join(wanted, same, "left_semi")
        rest = [c for c in mine.columns if c not in self.keys and c != "_batch"]
        last = mine.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
        return last.select(*self.keys, *[F.col(f"_last.{c}").alias(c) for c in rest])

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """The aggregate as of now; groups that have no row left are gone."""
        changes = spark.read.parquet(f"{self.path}/changes")
        if where is not None:
            changes = changes.where(where)
        sums = changes.groupBy(*self.groups).agg(*[F.sum(m).alias(m) for m in self.measures], F.sum("rows").alias("rows"))
        return sums.where("rows > 0").drop("rows")

    def fold(self, spark: SparkSession, upto: int) -> None:
        """Adds the changes of batches up to ``upto`` (finished ones) into the folder of that batch.
        Folders are replaced one after another: run it while nobody reads the aggregate.  The
        stream may go on: its batches are later ones."""
        changes = spark.read.parquet(f"{self.path}/changes").where(F.col("batch") <= int(upto))
        sums = changes.groupBy(*self.groups).agg(*[F.sum(m).alias(m) for m in self.measures], F.sum("rows").alias("rows"))
        checkpoint_root(spark)
        sums = sums.checkpoint(eager=True)
        empty = sums.limit(0)
        numbers = [r[0] for r in changes.select("batch").distinct().collect()]
        for number in numbers:
            (sums if number == int(upto) else empty).write.mode("overwrite").parquet(f"{self.path}/changes/batch={number}")
        if int(upto) not in numbers:
            sums.write.mode("overwrite").parquet(f"{self.path}/changes/batch={int(upto)}")


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out
