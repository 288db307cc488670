"""What a join of streams remembers between micro-batches, in tables beside its output.

The engine's state store puts every row of a batch one by one, also those that never wait for
another batch.  Here a micro-batch is joined by ordinary joins and only the rows that still wait
are written, with the event time that each side has reached.  A batch writes folders of its own
number and its marks last, and reads those of the last finished batch before it, so a batch that is
run again replaces what it wrote.  Folders that no batch can read again are removed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sinks.generations import _fs, _numbers

_MARKS = "reached map<string,bigint>, watermark bigint, before bigint"


@dataclass(frozen=True)
class Marks:
    """Event time in milliseconds after a batch: the largest of each side, the watermark, and the
    watermark of the batch before.  None: not known yet."""

    reached: dict[str, int | None] = field(default_factory=dict)
    watermark: int | None = None
    before: int | None = None

    def advanced(self, seen: dict[str, int | None], lateness_ms: int) -> "Marks":
        """The marks after a batch with these largest times: the slowest side counts, and one without rows
        holds the watermark back."""
        sides = {**self.reached, **seen}
        reached = {s: max((t for t in (self.reached.get(s), seen.get(s)) if t is not None), default=None) for s in sides}
        known = None if None in reached.values() else min(reached.values()) - lateness_ms
        return Marks(reached, known, self.watermark)


@dataclass(frozen=True)
class Waiting:
    path: str

    def last(self, spark: SparkSession, before: int | None = None) -> int | None:
        """The last finished batch (before another)."""
        done = _numbers(spark, f"{self.path}/marks", "batch", True)
        return max((n for n in done if before is None or n < before), default=None)

    def marks(self, spark: SparkSession, number: int | None) -> Marks:
        if number is None:
            return Marks()
        row = spark.read.schema(_MARKS).parquet(f"{self.path}/marks/batch={number}").first()
        return Marks(dict(row["reached"]), row["watermark"], row["before"])

    def rows(self, spark: SparkSession, number: int | None, name: str) -> DataFrame | None:
        """What a batch kept under a name, if it kept any."""
        path = f"{self.path}/{name}/batch={number}"
        fs, hpath = _fs(spark, path)
        return spark.read.parquet(path) if number is not None and fs.exists(hpath(path)) else None

    def keep(self, rows: DataFrame, number: int, name: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={int(number)}")

    def finish(self, spark: SparkSession, number: int, marks: Marks, names: tuple[str, ...]) -> None:
        """Writes the marks; a batch is finished with them.  What older batches than the one
        before kept under ``names`` is removed: a replay of this batch reads the one before."""
        previous = self.last(spark, number)
        reached = F.create_map(*[x for s, t in marks.reached.items() for x in (F.lit(s), F.lit(t).cast("bigint"))])
        row = spark.range(1, numPartitions=1).select(
            reached.alias("reached"), F.lit(marks.watermark).cast("bigint").alias("watermark"), F.lit(marks.before).cast("bigint").alias("before"))
        row.write.mode("overwrite").parquet(f"{self.path}/marks/batch={int(number)}")
        fs, hpath = _fs(spark, self.path)
        for name in (*names, "marks"):
            for n in _numbers(spark, f"{self.path}/{name}", "batch", False):
                if previous is not None and n < previous:
                    fs.delete(hpath(f"{self.path}/{name}/batch={n}"), True)


def read_finished(spark: SparkSession, table: str, waiting: Waiting, schema=None) -> DataFrame:
    """Rows that finished batches wrote into their folders ``batch=n`` of a table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    last = waiting.last(spark)
    return reader.parquet(table).where(F.col("batch") <= F.lit(-1 if last is None else last)).drop("batch")
