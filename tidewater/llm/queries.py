"""The ``opN_<name>`` queries over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import (
    bloom_lm, decontamination, language_id, line_dedup, mixing, ngram_join, pii, prefix_trie, quality_classifier, quality_rules,
    sentence_pieces, spelling, sql, warc,
)
from tidewater.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle:
            SQL[name] = oracle
        return fn
    return wrap


@query("op1_pii", sql.PII)
def op1_pii(spark, sf_dir):
    return pii.digest(read_table(spark, sf_dir, "documents"))


@query("op2_ngram_join", sql.NGRAM_JOIN)
def op2_ngram_join(spark, sf_dir):
    return ngram_join.link_classes(read_table(spark, sf_dir, "documents"), k=3, percent=90)


@query("op3_mixing", sql.MIXING)
def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op4_quality_rules", sql.QUALITY_RULES)
def op4_quality_rules(spark, sf_dir):
    return quality_rules.apply_rules(read_table(spark, sf_dir, "documents"))


@query("op5_decontamination", sql.DECONTAMINATION)
def op5_decontamination(spark, sf_dir):
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op6_bloom_lm")
def op6_bloom_lm(spark, sf_dir):
    return bloom_lm.score_texts(read_table(spark, sf_dir, "documents"))


@query("op7_line_dedup")
def op7_line_dedup(spark, sf_dir):
    return line_dedup.digest(read_table(spark, sf_dir, "documents"))


@query("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op9_warc", sql.WARC)
def op9_warc(spark, sf_dir):
    return warc.round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query("op11_spelling", sql.SPELLING)
def op11_spelling(spark, sf_dir):
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


@query("op12_sentence_pieces")
def op12_sentence_pieces(spark, sf_dir):
    import public_tokenizers  # only this query needs the vocabulary files

    return sentence_pieces.digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_prefix_trie", sql.PREFIX_TRIE)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))
