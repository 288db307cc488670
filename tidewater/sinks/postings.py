"""Inverted index of a table of texts: term -> document, in bucketed folders.

``terms/bucket=b`` holds postings (term, doc_id, tf, length) with the batch that wrote them;
a term's bucket follows from the term, so a query reads the buckets of its terms and
nothing else.  ``docs/batch=n`` holds the documents of a batch with their version and terms, which a later
version needs to take back the postings of terms it no longer has (a posting with tf 0).
``stats/batch=n`` holds what a batch adds to the number of documents and to their length,
one row a batch.

A micro-batch is appended as it comes, whatever is there already: readers resolve the
newest posting of each (term, document), which is that of the last batch that has the document, as a batch leaves out
versions that are not newer than those before it.  The documents are written first and
the postings are made from what was written, so the batch is worked out once and not kept elsewhere.  A batch that is
replayed looks at earlier batches only, replaces its documents, writes equal postings again (resolved away) and
replaces its own statistics, so replays change no answer.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions import token_list
from tidewater.sinks.generations import _numbers

BUCKETS = 64
# Rows of a batch go to each bucket in about this many files, more if the batch has more documents than
# a file should have rows of one term.
FILES_A_BUCKET = 2
DOCS_A_FILE = 500_000
# Postings that a task groups and sorts in memory.
POSTINGS_A_TASK = 300_000


def bucket_of(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(buckets)).cast("int")


def _bucket(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode()) % buckets


def _files(docs: int) -> int:
    return max(FILES_A_BUCKET, -(-docs // DOCS_A_FILE))


def _dealt(rows: DataFrame, key: str, files: int, partitions: int | None = None) -> DataFrame:
    """A bucket's rows in few files (``slot``); a term that most documents have is split by document."""
    to = ("bucket", "slot") if partitions is None else (partitions, "bucket", "slot")
    return rows.withColumn("slot", F.pmod(F.hash(key), F.lit(files))).repartition(*to)


def append_documents(batch: DataFrame, path: str, batch_id: int, buckets: int = BUCKETS,
                     analyze: Callable[[str], Column] = token_list) -> None:
    """Index a batch of (doc_id, text, version), one row a document; ``version`` is of any
    type with an order.  If a document comes more than once its newest version counts, and equal ones are added up.
    A version not newer than the indexed one changes nothing; a null text has no terms; rows without an id are left out.
    ``analyze`` gives a text's tokens with repeats."""
    spark = batch.sparkSession
    new = batch.where(F.col("doc_id").isNotNull()).select("doc_id", "version", "text").repartition("doc_id")
    newest = F.max("version").over(Window.partitionBy("doc_id"))
    new = new.withColumn("newest", newest).where(F.col("version").eqNullSafe(F.col("newest"))).drop("newest")
    old = _known(spark, path, batch_id)
    if old is None:
        new = new.select("*", F.lit(None).cast("array<string>").alias("old_terms"), F.lit(None).cast("int").alias("old_length"))
    else:
        new = new.join(old, "doc_id", "left").where("old_version is null or version > old_version")
    # Tokens after the join: a text crosses its shuffle in less than its words do.
    words = new.withColumn("words", F.coalesce(analyze("text"), F.array().cast("array<string>"))).withColumn("terms", F.array_distinct("words"))
    tfs = F.transform("terms", lambda t: F.size(F.filter("words", lambda w: w == t)))
    docs = words.select("doc_id", "version", "terms", tfs.alias("tfs"), F.size("words").alias("length"), "old_length",
                        F.coalesce(F.array_except("old_terms", "words"), F.array().cast("array<string>")).alias("gone"))
    docs.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/docs/batch={int(batch_id)}")
    _write_postings(spark, path, int(batch_id), buckets)


def _known(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Newest version, terms and length of the documents of earlier batches."""
    earlier = [f"{path}/docs/batch={n}" for n in _numbers(spark, f"{path}/docs", "batch", True) if n < batch_id]
    if not earlier:
        return None
    docs = spark.read.parquet(*earlier).select("doc_id", "version", "terms", "length")
    # Few documents are there twice: they are shuffled as they are, without sorting them for it.
    last = docs.repartition("doc_id").groupBy("doc_id").agg(F.max(F.struct("version", "terms", "length")).alias("x"))
    return last.select("doc_id", F.col("x.version").alias("old_version"), F.col("x.terms").alias("old_terms"),
                       F.col("x.length").alias("old_length"))


def _write_postings(spark: SparkSession, path: str, batch_id: int, buckets: int) -> None:
    """The postings and the statistics of a batch whose documents are written."""
    docs = spark.read.parquet(f"{path}/docs/batch={batch_id}")
    count, known, length, rows = docs.agg(
        F.count(F.lit(1)), F.count("old_length"), F.sum(F.col("length") - F.coalesce("old_length", F.lit(0))),
        F.sum(F.size("terms") + F.size("gone"))).first()
    if not count:
        return
    gone = F.transform("gone", lambda t: F.struct(t.alias("terms"), F.lit(0).alias("tfs")))
    held = docs.select("doc_id", "length", F.inline(F.concat(F.arrays_zip("terms", "tfs"), gone)).alias("term", "tf"))
    # A row a term and document crosses one shuffle, that of its bucket's files; equal ones are added up there.
    dealt = _dealt(held.withColumn("bucket", bucket_of(F.col("term"), buckets)), "doc_id", _files(count), 1 + rows // POSTINGS_A_TASK)
    added = dealt.groupBy("bucket", "slot", "term", "doc_id", "length").agg(F.sum("tf").cast("int").alias("tf"))
    added.select("term", "doc_id", "tf", "length", F.lit(batch_id).cast("long").alias("batch"), "bucket").sortWithinPartitions(
        "bucket", "term").write.mode("append").option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/terms")
    stats = spark.range(1, numPartitions=1).select(F.lit(count - known).cast("long").alias("docs"), F.lit(length).cast("long").alias("length"))
    stats.write.mode("overwrite").parquet(f"{path}/stats/batch={batch_id}")


def postings(spark: SparkSession, path: str, terms: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(term, doc_id, tf, length) of the terms as of now, from their buckets only."""
    wanted = sorted({_bucket(t, buckets) for t in terms})
    rows = spark.read.parquet(f"{path}/terms").where(F.col("bucket").isin(wanted) & F.col("term").isin(list(terms)))
    # Dealt by document, as the query adds up each document's terms next.
    last = rows.repartition("doc_id").groupBy("term", "doc_id").agg(F.max(F.struct("batch", "tf", "length")).alias("x"))
    return last.select("term", "doc_id", "x.tf", "x.length").where("tf > 0")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """(docs, length) of the index: one row, from one row a batch."""
    return spark.read.parquet(f"{path}/stats").agg(F.sum("docs").alias("docs"), F.sum("length").alias("length"))


def search(spark: SparkSession, path: str, terms: list[str], k1: float, b: float, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, score): documents with all the terms, by BM25.  The terms' document
    frequencies are counted on the postings read for the query."""
    found = postings(spark, path, terms, buckets)
    if not terms:
        return found.select("doc_id", F.lit(0.0).alias("score")).where(F.lit(False))
    # One row a term of the query, so it is small whatever the index.
    seen = found.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))
    whole = totals(spark, path).select(F.struct(
        F.col("docs").cast("double").alias("n"), (F.col("length") / F.col("docs")).alias("mean")).alias("s")).scalar()
    idf = F.log(F.lit(1.0) + (whole.getField("n") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    tf = F.col("tf").cast("double")
    length = F.lit(1.0 - b) + F.lit(b) * F.col("length") / whole.getField("mean")
    part = idf * tf * F.lit(k1 + 1.0) / (tf + F.lit(k1) * length)
    scored = found.join(F.broadcast(seen), "term").groupBy("doc_id").agg(
        F.sum(part).alias("score"), F.count(F.lit(1)).alias("matched"))
    return scored.where(F.col("matched") == len(set(terms))).select("doc_id", "score")
