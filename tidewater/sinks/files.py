"""File sinks: the raw-log archive and console output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import log_date


def archive_lines(lines: DataFrame, path: str, value_col: str = "value", ts_col: str = "received_ms") -> None:
    """Durable raw copy: one JSON text a line, one folder per UTC day.

    ``append`` adds new files next to earlier ones (the daily rolling file of
    the reference).  Each day is written by one task, a hot day by as many
    as its size needs.
    """
    out = lines.select(F.col(value_col).alias("value"), log_date(ts_col).alias("day"))
    out.hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read the archive back; ``day`` stays a string partition column."""
    return spark.read.schema("value string, day string").text(path)


def show_rows(df: DataFrame, n: int = 100) -> None:
    """Console sink of the reference's debug output (up to ``n`` rows)."""
    df.show(n, truncate=False)


def console_stream(df: DataFrame, checkpoint: str, n: int = 100, trigger: dict | None = None):
    """Console sink of a stream (debug output of up to ``n`` rows a batch)."""
    writer = df.writeStream.format("console").option("numRows", n).option("truncate", False)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
