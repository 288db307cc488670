"""The inverted index against scores over the whole table, over batches and replays."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.operators import search
from tidewater.session import scratch_path
from tidewater.sinks import postings

WORDS = ["red", "blue", "ring", "box", "steel", "lamp", "small", "café"]


@pytest.fixture(scope="module")
def batches(spark):
    random.seed(2)
    out = []
    for b in range(4):
        ids = random.sample(range(120), 50)
        out.append([(f"d{i}", " ".join(random.choices(WORDS, k=random.randint(0, 6))) if i % 17 else None, b * 10 + i % 3) for i in ids])
    # An older version of a document comes after a newer one.
    out[3] = [r for r in out[3] if r[0] != "d1"] + [("d1", "red ring", -5)]
    return out


def index(spark, batches, replay=()):
    path = scratch_path(spark, "index")
    for n, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, "doc_id string, text string, version int")
        for _ in range(2 if n in replay else 1):
            postings.append_documents(batch, path, n)
    return path


def expected(spark, batches, keyword):
    newest = {}
    for rows in batches:
        for doc, text, version in rows:
            if doc not in newest or version > newest[doc][1]:
                newest[doc] = (text, version)
    corpus = spark.createDataFrame([(d, t or "") for d, (t, _) in newest.items()], "doc_id string, sku_name string")
    found = corpus.where(search.all_tokens_match("sku_name", keyword))
    scored = search.bm25_scores(corpus, found, keyword)
    return {r["doc_id"]: round(r["score"], 9) for r in scored.collect()}


def answer(spark, path, keyword):
    found = postings.search(spark, path, search._keyword_tokens(keyword), search.BM25_K1, search.BM25_B)
    return {r["doc_id"]: round(r["score"], 9) for r in found.collect()}


@pytest.mark.parametrize("replay", [(), (0, 2, 3)])
def test_index_of_batches_equals_whole_table(spark, batches, replay):
    path = index(spark, batches, replay)
    for keyword in ("red", "red ring", "Café small", "nothing", "", "red red"):
        want = expected(spark, batches, keyword) if keyword else {}
        assert answer(spark, path, keyword) == want, keyword
    assert len(answer(spark, path, "red")) > 10


def test_a_replay_of_an_earlier_batch_changes_nothing(spark, batches):
    path = index(spark, batches)
    before = answer(spark, path, "red")
    postings.append_documents(spark.createDataFrame(batches[3], "doc_id string, text string, version int"), path, 3)
    assert answer(spark, path, "red") == before


def test_a_query_reads_its_buckets_only(spark, batches):
    path = index(spark, batches)
    files = postings.postings(spark, path, ["red", "ring"]).inputFiles()
    wanted = {f"bucket={postings._bucket(t, postings.BUCKETS)}" for t in ("red", "ring")}
    assert len(wanted) == 2
    plan = postings.postings(spark, path, ["red", "ring"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan
    # Files named by the scan, after pruning.
    read = {f.split("/")[-2] for f in spark.read.parquet(f"{path}/terms").where(
        F.col("bucket").isin([postings._bucket(t, postings.BUCKETS) for t in ("red", "ring")])).select(
        F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert read == wanted and files


def test_null_ids_and_empty_batches(spark):
    path = scratch_path(spark, "index")
    schema = "doc_id string, text string, version int"
    postings.append_documents(spark.createDataFrame([], schema), path, 0)
    postings.append_documents(spark.createDataFrame([(None, "red", 1), ("a", "red red", 1), ("b", None, 1)], schema), path, 1)
    assert set(answer(spark, path, "red")) == {"a"}
    assert tuple(postings.totals(spark, path).first()) == (2, 2)


def test_a_replayed_batch_replaces_its_documents(spark, batches):
    once, again = index(spark, batches), index(spark, batches, replay=(0, 2, 3))
    docs = [spark.read.parquet(f"{p}/docs").groupBy("batch").count().collect() for p in (once, again)]
    assert sorted(map(tuple, docs[0])) == sorted(map(tuple, docs[1])) and len(docs[0]) == 4
    # What orders postings is the batch, not a version in each of them.
    assert set(spark.read.parquet(f"{once}/terms").columns) == {"term", "doc_id", "tf", "length", "batch", "bucket"}


def test_documents_cross_one_shuffle_each(spark, batches, monkeypatch):
    """Known ones are not sorted or grouped for it."""
    path = index(spark, batches[:2])
    plan = postings._known(spark, path, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and "Aggregate" not in plan[plan.index("Exchange hashpartitioning"):]
    assert postings._known(spark, path, 0) is None
    # All of a document's postings of a query are where they are added up.
    found = postings.search(spark, path, ["red"], search.BM25_K1, search.BM25_B)
    assert not re.search(r"hashpartitioning\(term#\d+, doc_id", found._jdf.queryExecution().executedPlan().toString())
    # Tasks grow in number with the postings.
    monkeypatch.setattr(postings, "POSTINGS_A_TASK", 20)
    many = index(spark, batches)
    for keyword in ("red", "red ring"):
        assert answer(spark, many, keyword) == expected(spark, batches, keyword)


def test_documents_of_an_unfinished_batch_are_not_known(spark, batches):
    path = index(spark, batches[:1])
    unfinished = spark.createDataFrame([("d0", 99, ["zebra"], 1)], "doc_id string, version int, terms array<string>, length int")
    unfinished.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/docs/batch=1")
    postings.append_documents(spark.createDataFrame(batches[1], "doc_id string, text string, version int"), path, 2)
    assert answer(spark, path, "red") == expected(spark, batches[:2], "red")


def test_equal_documents_of_a_batch_are_added_up(spark):
    path = scratch_path(spark, "index")
    postings.append_documents(spark.createDataFrame([("a", "red red ring", 1)] * 2 + [("b", "red", 1)], "doc_id string, text string, version int"), path, 0)
    got = sorted(tuple(r) for r in postings.postings(spark, path, ["red", "ring"]).collect())
    assert got == [("red", "a", 4, 3), ("red", "b", 1, 1), ("ring", "a", 2, 3)]
    assert tuple(postings.totals(spark, path).first()) == (3, 7)


def test_the_newest_version_in_a_batch_counts(spark):
    path = scratch_path(spark, "index")
    rows = [("a", "red red ring", 1), ("a", "red box", 2), ("b", "red", None), ("b", "ring", 0)]
    postings.append_documents(spark.createDataFrame(rows, "doc_id string, text string, version int"), path, 0)
    got = sorted(tuple(r) for r in postings.postings(spark, path, ["red", "ring", "box"]).collect())
    assert got == [("box", "a", 1, 2), ("red", "a", 1, 2), ("ring", "b", 1, 1)]
    assert tuple(postings.totals(spark, path).first()) == (2, 3)
