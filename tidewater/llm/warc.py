"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole WARC
records, and a seek table in a skippable frame at its end (the published
seekable format), so any Zstandard tool can read it and one record can be
read by decompressing one frame.  An index table maps each record to bundle,
frame, offset in the decompressed frame and length.

Writing is distributed: equal payloads are found by digest, then every task
writes the records of its own bundles (bounded by ``BUNDLE_BYTES``).  A bundle's
name and bytes follow from its records alone: a bundle is keyed by a hash of
the record's identity and its records are sorted, and the file is written under
a temporary name and renamed, so a task that is run again leaves the same file.

Edge cases: a null payload is empty; a null page_id sorts first and takes part
like any other; rows with the same page_id and payload as the response are
responses too; payloads under ``MIN_REVISIT_BYTES`` are always responses; a null
or odd URL is percent-encoded (null: left out); an empty table gives no bundles
and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_counted
from tidewater.session import scratch_path

MIN_REVISIT_BYTES = 100
FRAME_BYTES = 256 << 10  # records are added to a frame until it has this much
BUNDLE_BYTES = 32 << 20  # and frames to a bundle
# Bundles are written by as many tasks as there are bundles, up to this; a task writes its bundles one by one.
MAX_TASKS = 20_000
WARC_DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date: reruns are byte-equal
# Fixed values of the seekable format: skippable frame and footer magic numbers.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")

PLAN = ("page_id", "url", "payload", "payload_bytes", "digest", "record_type", "refers_to")
INDEX_SCHEMA = "page_id long, record_id string, bundle string, frame int, offset long, length long"


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}/{kind}')}"


def record_bytes(page_id, url, payload: bytes | None, payload_bytes: int, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record.  A revisit has no block: it names the response that
    has the same payload."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id(page_id, digest, kind)}>",
        f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {payload_bytes}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~')}")
    block = payload or b""
    if kind == "revisit":
        block = b""
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{record_id(refers_to, digest, 'response')}>")
        head.append(f"X-Refers-To-Page: {refers_to}")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records of a decompressed frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = end + 4
        at = block + int(headers["Content-Length"])
        yield headers, data[block:at]
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError("record without its end")
        at += 4


class Bundle:
    """Frames and their seek table, in memory (``BUNDLE_BYTES`` and one record)."""

    def __init__(self, level: int = 3):
        self._packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self._frames: list[bytes] = []
        self._table: list[tuple[int, int]] = []
        self._open = bytearray()

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset in it of the added record."""
        if self._open and len(self._open) + len(record) > FRAME_BYTES:
            self._close_frame()
        place = len(self._frames), len(self._open)
        self._open += record
        return place

    def _close_frame(self) -> None:
        frame = self._packer.compress(bytes(self._open))
        self._frames.append(frame)
        self._table.append((len(frame), len(self._open)))
        self._open = bytearray()

    def to_bytes(self) -> bytes:
        if self._open:
            self._close_frame()
        entries = b"".join(struct.pack("<II", *e) for e in self._table)
        footer = FOOTER.pack(len(self._table), 0, SEEKABLE_MAGIC)
        table = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer
        return b"".join(self._frames) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) per frame, from the footer."""
    n, flags, magic = FOOTER.unpack(bundle[-FOOTER.size:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    size = 12 if flags & 0x80 else 8
    at, out = 0, []
    first = len(bundle) - FOOTER.size - n * size
    for i in range(n):
        packed, full = struct.unpack_from("<II", bundle, first + i * size)
        out.append((at, packed, full))
        at += packed
    return out


def read_frame(bundle: bytes, frame: int) -> bytes:
    start, packed, full = seek_table(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[start:start + packed], max_output_size=full)


def plan_records(pages: DataFrame) -> DataFrame:
    """``PLAN`` per row of ``pages`` (page_id, url, html).  A revisit needs no payload
    from here on, so copies of a hot payload are shuffled as their headers.

    The first page of each payload is found by a grouped minimum of digests
    (partial sums before the shuffle, so a hot payload is one row per task);
    only digests that occur on several pages are joined back, where a count
    shows them few without a shuffle of the pages.
    """
    rows = pages.select(
        F.col("page_id"), F.col("url"), F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (
        rows.where(F.length("payload") >= MIN_REVISIT_BYTES).groupBy(F.col("digest").alias("first_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    joined = rows.join(broadcast_if_counted(firsts), F.col("digest") == F.col("first_digest"), "left")
    revisit = F.coalesce(F.col("page_id") > F.col("first_id"), F.lit(False))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"),
        F.length("payload").alias("payload_bytes"), "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _write_bundles(uri: str):
    """Task: sorted records of several bundle keys to files and index rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(uri)

        def store(name: str, bundle: Bundle) -> None:
            temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temporary) as out:
                out.write(bundle.to_bytes())
            fs.move(temporary, f"{root}/{name}")

        key, part, size, bundle, index = None, 0, 0, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if bundle is not None and (row["bundle_key"] != key or size >= BUNDLE_BYTES):
                    store(name, bundle)
                    part = part + 1 if row["bundle_key"] == key else 0
                    bundle = None
                if bundle is None:
                    key, size, bundle = row["bundle_key"], 0, Bundle()
                    name = f"bundle-{key:08d}-{part:04d}.warc.zst"
                record = record_bytes(*(row[c] for c in PLAN))
                frame, offset = bundle.add(record)
                size += len(record)
                rid = record_id(row["page_id"], row["digest"], row["record_type"])
                index.append((row["page_id"], rid, name, frame, offset, len(record)))
            if index:
                yield _index_batch(index)
                index = []
        if bundle is not None:
            store(name, bundle)

    return run


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def write_archives(pages: DataFrame, uri: str, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes the bundles into the folder ``uri`` and returns the index table
    (``INDEX_SCHEMA``), stored beside them.

    ``uri`` is a shared folder that pyarrow can open (file, hdfs, s3, gs).
    The number of bundles follows from the bytes of all payloads.
    """
    spark = pages.sparkSession
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    n = max(1, -(-2 * total // bundle_bytes))
    fs, root = _file_system(uri)
    fs.create_dir(f"{root}/archives", recursive=True)
    rows = plan_records(pages)
    key = F.pmod(F.xxhash64(F.col("page_id"), F.col("digest")), F.lit(n)).cast("long")
    dealt = (
        rows.withColumn("bundle_key", key)
        .repartition(min(MAX_TASKS, max(n, spark.sparkContext.defaultParallelism)), "bundle_key")
        .sortWithinPartitions("bundle_key", "page_id", "digest", "url")
    )
    index = dealt.select("bundle_key", *PLAN).mapInArrow(_write_bundles(f"{uri}/archives"), INDEX_SCHEMA)
    index.write.parquet(f"{uri}/index")
    return spark.read.schema(index.schema).parquet(f"{uri}/index")


RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def _read_bundles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    for batch in batches:
        for content in batch.column(0):
            bundle = content.as_py()
            unpack = zstandard.ZstdDecompressor()
            for start, packed, full in seek_table(bundle):
                rows = []
                data = unpack.decompress(bundle[start:start + packed], max_output_size=full)
                for headers, block in parse_records(data):
                    kind = headers["WARC-Type"]
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    page, first = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                    intact = kind == "revisit" or hashlib.sha256(block).hexdigest() == digest
                    rows.append((
                        int(page) if page is not None else None,
                        int(headers["X-Payload-Length"]) if kind == "revisit" else len(block),
                        digest if kind == "revisit" else hashlib.sha256(block).hexdigest(), kind,
                        int(first) if first is not None else None, intact))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_archives(spark: SparkSession, uri: str) -> DataFrame:
    """Every record of every bundle, read back and verified (``RECORD_SCHEMA``)."""
    bundles = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(f"{uri}/archives")
    return bundles.select("content").mapInArrow(_read_bundles, RECORD_SCHEMA)


def read_record(uri: str, bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: reads the footer and a single frame."""
    fs, root = _file_system(uri)
    with fs.open_input_file(f"{root}/archives/{bundle}") as f:
        size = f.size()
        n, _, magic = FOOTER.unpack(f.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle")
        entries = f.read_at(8 * n, size - FOOTER.size - 8 * n)
        sizes = [struct.unpack_from("<II", entries, 8 * i) for i in range(n)]
        start = sum(s[0] for s in sizes[:frame])
        data = zstandard.ZstdDecompressor().decompress(f.read_at(sizes[frame][0], start), max_output_size=sizes[frame][1])
    return next(parse_records(data[offset:offset + length]))


def round_trip(pages: DataFrame) -> DataFrame:
    """op9: archives of all pages in the shared folder, read back.  One row per
    page: page_id, payload_bytes, payload_digest, record_type, refers_to, intact."""
    spark = pages.sparkSession
    uri = scratch_path(spark, "warc")
    write_archives(pages, uri)
    return read_archives(spark, uri)
