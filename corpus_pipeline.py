"""The corpus pipeline: five stages, each written as Parquet and read by the next.

1. ``quality_classifier``: documents scored under the threshold go.
2. ``line_dedup``: repeated lines go, fuzzily; a document that had lines and has no
   word left goes too.
3. ``ngram_join``: of documents linked by word shingles (five words, Jaccard 0.8 or
   more) the one with the smallest id stays.
4. ``decontamination``: documents that hold a benchmark item go.
5. ``mixing``: the words to take of each document, so that sources meet their weights.

Every stage works on all its predecessor kept.  Documents keep their columns, extra
ones included, up to the last stage, which adds to them the columns of the mix
(``mix_size``, ``mix_target``, ``mix_copies``, ``mix_part_words``, ``mix_taken``) and leaves out
documents of which the mix takes nothing.

Edge cases follow the operators': a null text counts as empty; documents with a null id
pass stages that name documents by id; rows that share an id stay or go together
where ids are compared; empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontamination, line_dedup, mixing, ngram_join, quality_classifier
from tidewater.llm.common import WORD, written
from tidewater.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.passing(docs, model, docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.remove_lines(docs)
    emptied = (F.col(left.columns[-1]) > 0) & ~F.col("text").rlike(WORD)
    return left.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, k=5, percent=80).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, read_table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]

# The classifier's fit and the fuzzy line groups have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; each stage's result is a written
    table, so a lost executor costs the running stage's tasks only."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
