"""Feed of row changes that a stream reads with offsets of its own.

The feed is a folder of numbered segments, each a set of Parquet files that counts once its
success marker is there.  A reader's offset is the number of the next segment: the engine
records it per micro-batch before the batch runs, and reads the same segments again
when a batch was not committed, so no entry is lost or read twice across a restart.

Inside a task the entries come in fetches of at most ``fetchEntries`` as Arrow batches, so a
task holds one fetch however large its file is.  Files are a task each; ``append_changes``
bounds their entries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewater.session import prepare_session

# Fixed value that must equal the reference's: entries of one fetch.
FETCH_ENTRIES = 100
FILE_ENTRIES = 100_000
SCHEMA = "`table` string, entry_type string, event_type string, seq long, after map<string,string>"
COLUMNS = ["table", "entry_type", "event_type", "seq", "after"]
FORMAT = "change_feed"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def _segments(files: pafs.FileSystem, root: str) -> dict[int, bool]:
    """Numbers of the feed's segments, with whether each is finished."""
    entries = files.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    numbers = [int(e.base_name.split("=", 1)[1]) for e in entries
               if e.type == pafs.FileType.Directory and e.base_name.startswith("segment=")]
    markers = files.get_file_info([f"{root}/segment={n}/_SUCCESS" for n in numbers]) if numbers else []
    return {n: m.type == pafs.FileType.File for n, m in zip(numbers, markers, strict=True)}


def append_changes(changes: DataFrame, path: str, file_entries: int = FILE_ENTRIES) -> int:
    """Adds ``changes`` (the columns of ``SCHEMA``) as the feed's next segment and returns its
    number.  One writer at a time; a segment that it leaves unfinished is never read."""
    files, root = _file_system(path)
    number = max(_segments(files, root), default=-1) + 1
    changes.select(*COLUMNS).write.option("maxRecordsPerFile", file_entries).parquet(f"{path}/segment={number}")
    return number


class ChangeFeedReader(DataSourceStreamReader):
    """Segments of the feed under the option ``path``."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.fetch_entries = int(options.get("fetchEntries", FETCH_ENTRIES))

    def initialOffset(self) -> dict:
        return {"segment": 0}

    def latestOffset(self) -> dict:
        finished = [n for n, done in _segments(*_file_system(self.path)).items() if done]
        return {"segment": max(finished, default=-1) + 1}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        files, root = _file_system(self.path)
        wanted = sorted(n for n, done in _segments(files, root).items() if done and start["segment"] <= n < end["segment"])
        listed = [e.path for n in wanted for e in files.get_file_info(pafs.FileSelector(f"{root}/segment={n}"))]
        return [InputPartition(p) for p in sorted(listed) if p.endswith(".parquet")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        files, _ = _file_system(self.path)
        with files.open_input_file(partition.value) as file:
            yield from pq.ParquetFile(file).iter_batches(batch_size=self.fetch_entries, columns=COLUMNS)


class ChangeFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ChangeFeedReader:
        return ChangeFeedReader(self.options)


def change_stream(spark: SparkSession, path: str, fetch_entries: int = FETCH_ENTRIES) -> DataFrame:
    """The feed as a stream; a micro-batch takes the segments finished since the last one."""
    prepare_session(spark)
    spark.dataSource.register(ChangeFeed)
    return spark.readStream.format(FORMAT).option("path", path).option("fetchEntries", fetch_entries).load()
