"""Streaming scans.

No message-bus connector is on the class path here, so streams read files: a
directory of parquet (or JSON-lines) files, one table per glob.  With a bus,
``format('kafka')`` and ``subscribe`` take the place of the path; everything
downstream is the same DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.session import prepare_session
from tidewater.sources.tables import TABLES, table_path


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath)) and bool(fs.getFileStatus(hpath).isDirectory())


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of one table: of the folder ``sf_dir/name/`` or
    ``sf_dir/name.parquet/`` (each file a unit of arrival), else the single file
    ``sf_dir/name.parquet``.  The schema is taken from the files' footers (a
    stream needs it up front)."""
    prepare_session(spark)
    folders = [f"{sf_dir.rstrip('/')}/{name}", table_path(sf_dir, name)]
    folder = next((f for f in folders if _is_dir(spark, f)), None)
    if folder:
        reader = spark.readStream.schema(spark.read.parquet(folder).schema)
        src = folder
    else:
        schema = spark.read.parquet(table_path(sf_dir, name)).schema
        reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
        src = sf_dir
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(src)


def json_lines_stream(spark: SparkSession, path: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream JSON-lines files with a fixed schema (nothing is inferred)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """Raw log lines, one string column ``value``."""
    return spark.readStream.text(path)


class StreamTables:
    """Same interface as :class:`tidewater.sources.tables.Tables`, but the
    named tables are streams; ``static`` gives the batch twin of the
    dimension tables that streams join against."""

    def __init__(self, spark: SparkSession, sf_dir: str, streamed=("events", "orders", "lineitem"),
                 max_files_per_trigger: int | None = None, stream_dir: str | None = None):
        from tidewater.sources.tables import Tables

        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir
        self.stream_dir = stream_dir or sf_dir
        self.streamed = set(streamed)
        self.max_files = max_files_per_trigger
        self.static = Tables(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name in self.streamed:
                return table_stream(self.spark, self.stream_dir, name, self.max_files)
            return getattr(self.static, name)
        raise AttributeError(name)


class BatchTables:
    """Same interface, with the rows of a micro-batch in place of some tables."""

    def __init__(self, static, **batch: DataFrame):
        self.static, self.batch = static, batch

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.batch[name] if name in self.batch else getattr(self.static, name)
        raise AttributeError(name)


def union_topics(*streams: DataFrame) -> DataFrame:
    """One stream out of several subscriptions (columns matched by name;
    a column missing in one input is null there)."""
    out = streams[0]
    for other in streams[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
