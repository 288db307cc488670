"""Extra columns with the names that operators use inside: kept, and they change nothing."""

import pytest

import corpus_pipeline
from tidewater.llm import decontamination, line_dedup, mixing, ngram_join

from .test_operators import sentence

EXTRA = "_id int, places int, _lines int, _removed int, _gone int, _leaked int, MIX_SIZE int, mix_taken int"


@pytest.fixture(scope="module")
def docs(spark):
    item = sentence(40, 12)
    line = sentence(41, 14)
    texts = [sentence(1, 40), sentence(1, 40), f"{line}\n{sentence(2, 30)}", f"{sentence(3, 30)}\n{line}", f"{sentence(4, 20)} {item} end", None]
    rows = [(i, t, "en", "ab"[i % 2], *range(8)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {EXTRA}")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, sentence(40, 12))], "item_id long, text string")


def plain(docs):
    return docs.select("doc_id", "text", "lang", "source")


def extras_kept(out, names):
    return all([r[c] for c in names] == list(range(8)) for r in out.collect())


def test_lines(docs):
    out = line_dedup.remove_lines(docs)
    want = line_dedup.remove_lines(plain(docs))
    names = out.columns
    assert names == [*docs.columns, "_lines_", "_removed_"] and want.columns[-2:] == ["_lines", "_removed"]
    got = {r["doc_id"]: (r["text"], r["_lines_"], r["_removed_"]) for r in out.collect()}
    assert got == {r["doc_id"]: (r["text"], r["_lines"], r["_removed"]) for r in want.collect()}
    assert sum(v[2] for v in got.values()) >= 1 and extras_kept(out, docs.columns[4:])


def test_join_and_benchmark(docs, benchmark):
    for out, want in (
        (ngram_join.keep_one(docs), ngram_join.keep_one(plain(docs))),
        (decontamination.without_benchmark(docs, benchmark), decontamination.without_benchmark(plain(docs), benchmark)),
    ):
        left = sorted(r["doc_id"] for r in out.collect())
        assert out.columns == docs.columns and left == sorted(r["doc_id"] for r in want.collect())
        assert len(left) == 5 and extras_kept(out, docs.columns[4:])


def test_mix(docs):
    out = mixing.mix_documents(docs)
    assert out.columns == [*docs.columns, "mix_size_", "mix_target", "mix_copies", "mix_part_words", "mix_taken_"]
    assert extras_kept(out, docs.columns[4:]) and all(r["mix_taken_"] > 0 for r in out.collect())


def test_lines_stage(spark, docs):
    out = corpus_pipeline.lines(spark, docs, "")
    assert out.columns == docs.columns and extras_kept(out, docs.columns[4:])
