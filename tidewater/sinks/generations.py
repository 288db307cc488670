"""Keyed table of a stream that is compacted while the stream goes on.

A micro-batch writes its rows into a folder of its own number: one that fails between the
write and the commit of its offsets is run again by the resumed query and replaces what it
wrote, so every batch is in the table once, without a dedup of whole rows on read.

``compact`` folds everything up to a batch (a high-water mark) into a new generation
folder.  The folder counts from the moment its success marker is there, one file written
last; until then readers take the generation before, and the batches after its mark.  Batches
that arrive meanwhile are later ones and stay beside it, so nothing that is appended is lost
and no folder is ever rewritten.  Folders that a generation covers are removed by
``drop_covered``, once no reader uses an older one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.ingest import latest_per_key

_NEVER = -1


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system and path class, for folders of any store."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _numbers(spark: SparkSession, path: str, prefix: str, marked: bool) -> list[int]:
    """Numbers of the folders ``prefix=n`` under ``path``; ``marked``: of finished ones."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath(path)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hpath(path))]
    out = [int(n.split("=", 1)[1]) for n in names if n.startswith(f"{prefix}=")]
    return sorted(n for n in out if not marked or fs.exists(hpath(f"{path}/{prefix}={n}/_SUCCESS")))


@dataclass(frozen=True)
class GenerationTable:
    """The newest row of each key, of batches numbered from 0.  Later batches win; inside a batch the
    largest ``order`` column does.  A null key is a key like any other."""

    path: str
    keys: tuple[str, ...]
    order: str

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """A batch's rows, replacing those of an earlier run of it."""
        batch.write.mode("overwrite").parquet(f"{self.path}/batches/batch={int(batch_id)}")

    def mark(self, spark: SparkSession) -> int:
        """The last batch of the newest finished generation (-1: none)."""
        return max(_numbers(spark, f"{self.path}/generations", "upto", True), default=_NEVER)

    def _rows(self, spark: SparkSession, upto: int | None) -> DataFrame | None:
        """Rows of the newest generation and of the finished batches after it, with their batch."""
        mark = self.mark(spark)
        later = [n for n in _numbers(spark, f"{self.path}/batches", "batch", True) if n > mark and (upto is None or n <= upto)]
        parts = []
        if mark > _NEVER:
            parts.append(spark.read.parquet(f"{self.path}/generations/upto={mark}").withColumn("_batch", F.lit(mark).cast("long")))
        if later:
            base = f"{self.path}/batches"
            rows = spark.read.option("basePath", base).parquet(*[f"{base}/batch={n}" for n in later])
            parts.append(rows.withColumn("_batch", F.col("batch").cast("long")).drop("batch"))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The table as of now, or as of a batch that no generation has passed."""
        rows = self._rows(spark, upto)
        if rows is None:
            raise ValueError(f"no finished batch in {self.path}")
        versioned = rows.withColumn("_version", F.struct("_batch", self.order))
        return latest_per_key(versioned, self.keys, "_version").select(*[c for c in rows.columns if c != "_batch"])

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Folds batches up to ``upto``, all committed by the stream, into a generation."""
        if upto <= self.mark(spark):
            return
        self.read(spark, upto).write.mode("overwrite").parquet(f"{self.path}/generations/upto={int(upto)}")

    def drop_covered(self, spark: SparkSession) -> None:
        """Removes what the newest generation covers."""
        mark = self.mark(spark)
        fs, hpath = _fs(spark, self.path)
        for n in _numbers(spark, f"{self.path}/batches", "batch", False):
            if n <= mark:
                fs.delete(hpath(f"{self.path}/batches/batch={n}"), True)
        for n in _numbers(spark, f"{self.path}/generations", "upto", False):
            if n < mark:
                fs.delete(hpath(f"{self.path}/generations/upto={n}"), True)
