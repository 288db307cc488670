"""Session construction and the few runtime settings every query relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings that every plan in the package assumes.  They are all
# session-scoped, so they can be applied to a session someone else built.
RUNTIME_CONF = {
    # All wall-clock formatting (log dates, hours, minute keys) is done in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, split skewed join
    # partitions, and turn a sort-merge join into a broadcast one when the
    # runtime size of a side turns out to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Aggregations over a hot key get their partial (map-side) step; keep it.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


HEAP_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """Stream state goes to RocksDB (off-heap, spills to local disk, changelog
    checkpoints) instead of the JVM heap, unless the session already chose a
    provider of its own.  Applies to queries started afterwards; a restarted
    query keeps the provider recorded in its checkpoint."""
    prepare_session(spark)
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", HEAP_STATE_STORE)
    if provider == HEAP_STATE_STORE:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE_STORE)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tidewater",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session with the package's defaults.

    ``shuffle_partitions`` should be sized so one partition fits an executor's
    memory at the target scale; AQE then coalesces the small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return prepare_session(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and written tables.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Only when it is unset (local runs, tests) a fresh local
    folder is created and recorded in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one job."""
    root = checkpoint_root(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
