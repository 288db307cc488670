"""The registered queries against their SQL, and the pipeline stage by stage."""

from types import SimpleNamespace

import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.parity import compare, duck
from tidewater.llm import queries


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_sql(spark, name):
    spec = SimpleNamespace(name=name, run=queries.QUERIES[name], sql=queries.SQL[name])
    out = compare(spark, spec, SF_SMALL, duck(SF_SMALL))
    assert out["cols_match"] and out["types_match"] and out["values_match"], out


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_query_covers_every_document(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = docs.select("*").withColumnRenamed("n_chars", "key")
    before = {r["doc_id"] for r in rows.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF_SMALL)
        assert out.columns == rows.columns, name
        after = {r["doc_id"] for r in out.collect()}
        assert after <= before, name
        rows, before = out, after
    mixed = corpus_pipeline.STAGES[-1][1](spark, rows, SF_SMALL)
    assert {r["doc_id"] for r in mixed.collect()} <= before
    assert mixed.agg({"mix_taken": "sum"}).first()[0] > 0


def test_pipeline_on_empty_documents(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF_SMALL)
        assert rows.count() == 0


def test_quality_stage_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs.selectExpr("*", "1 as features", "2 as quality_score", "3 as _score", "4 as _words")
    stage = corpus_pipeline.STAGES[0][1]
    out = stage(spark, extra, SF_SMALL)
    assert out.columns == extra.columns
    plain = {r[0] for r in stage(spark, docs, SF_SMALL).select("doc_id").collect()}
    assert {r["doc_id"] for r in out.where("features = 1 and _score = 3").collect()} == plain
