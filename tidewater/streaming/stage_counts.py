"""Counts of rows before and after each stage of a running stream, kept in a table.

Stages are counted by the engine while a batch runs (``observe``: no pass of its own); a
listener writes the counts of every finished batch as rows (query, batch, stage, rows), a folder a
batch, so a batch that is run again replaces its counts.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewater.operators import dau as dau_ops
from tidewater.session import prepare_streaming
from tidewater.sinks.versioned import append_versions
from tidewater.sources import fixtures as fx
from tidewater.sources.streams import StreamTables
from tidewater.streaming.jobs import DAU_LATENESS, StreamRun, _finish, _start, _trigger, dau_stream

STAGE_LOGS, STAGE_STARTS, STAGE_FIRSTS = "logs", "starts", "firsts"
SCHEMA = "query string, batch long, stage string, rows long"


class StageCounts(StreamingQueryListener):
    """Writes the observed counts of all queries of the session under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, query: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(query, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query, batch = str(progress.id), int(progress.batchId)
        rows = [(query, batch, stage, int(m["rows"])) for stage, m in progress.observedMetrics.items()]
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/{query}/{batch}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.id)).set()

    def wait(self, query, seconds: float = 60) -> bool:
        """Until all counts of an ended query are written (its end is reported last)."""
        return self._event(str(query.id)).wait(seconds)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)


def run_counted_dau(spark: SparkSession, sf_dir: str, counts_path: str, run: StreamRun | None = None, trigger: dict | None = None,
                    max_files_per_trigger: int | None = None, stream_dir: str | None = None, lateness: str = DAU_LATENESS):
    """The device-day stream with counts of its logs, its starts and the first starts it
    gives (a device-day again when its start becomes earlier)."""
    prepare_streaming(spark)
    run = run or StreamRun.fresh(spark, "stream-dau-counted")
    t = StreamTables(spark, sf_dir, streamed=("events",), max_files_per_trigger=max_files_per_trigger, stream_dir=stream_dir)
    logs = dau_ops.count_stage(fx.v_log(t), STAGE_LOGS)
    starts = dau_ops.count_stage(logs.where(F.col("type") == "startup"), STAGE_STARTS)
    firsts = dau_ops.count_stage(dau_stream(starts, lateness), STAGE_FIRSTS)

    def write(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn("_rank", F.struct(*[F.col(c) for c in dau_ops.FIRST_ORDER]))
        append_versions(ordered, run.table, "logdate")

    counts = StageCounts(spark, counts_path)
    spark.streams.addListener(counts)
    try:
        q = _start(spark, _trigger(firsts.writeStream.outputMode("update").option("checkpointLocation", run.checkpoint)
                     .foreachBatch(write), trigger))
        _finish(q, trigger)
        if trigger and trigger.get("availableNow"):
            counts.wait(q)
    finally:
        if trigger and trigger.get("availableNow"):
            spark.streams.removeListener(counts)
    return q, run, counts
