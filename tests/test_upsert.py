import pytest

from tidewater.session import scratch_path
from tidewater.sinks.upsert import upsert


def test_upsert_replaces_by_key_and_is_idempotent(spark):
    path = scratch_path(spark, "test-upsert") + "/t"
    cols = "doc_id string, v string, version long, day string"
    b1 = spark.createDataFrame([("a", "1", 1, "d1"), ("b", "1", 1, "d1"), ("c", "1", 1, "d2")], cols)
    upsert(spark, b1, path, ["doc_id"], "version", "day")
    b2 = spark.createDataFrame([("a", "2", 2, "d1"), ("b", "0", 0, "d1"), (None, "x", 5, "d1")], cols)
    upsert(spark, b2, path, ["doc_id"], "version", "day")
    first = sorted(tuple(r) for r in spark.read.parquet(path).fillna("none").select("doc_id", "v", "day").collect())
    assert first == [("a", "2", "d1"), ("b", "1", "d1"), ("c", "1", "d2"), ("none", "x", "d1")]
    # replaying the same batch changes nothing, rows without a key included
    upsert(spark, b2, path, ["doc_id"], "version", "day")
    again = sorted(tuple(r) for r in spark.read.parquet(path).fillna("none").select("doc_id", "v", "day").collect())
    assert again == first
    # an untouched partition is left alone
    assert spark.read.parquet(path).where("day = 'd2'").count() == 1


def test_versioned_appends_read_latest_and_compact(spark):
    from pyspark.sql import functions as F

    from tidewater.sinks.versioned import append_versions, compact, read_latest

    path = scratch_path(spark, "test-versioned") + "/t"
    cols = "doc_id string, v string, version long, day string"
    append_versions(spark.createDataFrame([("a", "1", 1, "d1"), ("b", "1", 1, "d2")], cols), path, "day")
    append_versions(spark.createDataFrame([("a", "2", 2, "d1"), ("a", "0", 0, "d1")], cols), path, "day")
    append_versions(spark.createDataFrame([("a", "2", 2, "d1")], cols), path, "day")  # a replay

    def latest():
        return sorted((r["doc_id"], r["v"], str(r["day"])) for r in read_latest(spark, path, ["doc_id"], "version").collect())

    before = latest()
    assert before == [("a", "2", "d1"), ("b", "1", "d2")]
    assert spark.read.parquet(path).count() == 5
    compact(spark, path, ["doc_id"], "version", "day", partitions=["d1"])
    assert latest() == before
    assert spark.read.parquet(path).where(F.col("day").cast("string") == "d1").count() == 1
    assert spark.read.parquet(path).count() == 2


@pytest.mark.parametrize("max_rows", [0, 100])
def test_only_repeated_keys_are_grouped(spark, max_rows):
    from pyspark.sql import functions as F

    from tidewater.operators.ingest import latest_per_key
    from tidewater.sinks.versioned import latest_if_repeated

    rows = [(f"k{n}", str(v), v) for n in range(40) for v in range(1 + (n % 5 == 0) * 2)]
    table = spark.createDataFrame(rows, "id string, v string, version long")
    got = latest_if_repeated(table, ["id"], F.col("version"), ("v", "id"), max_rows)
    assert got.columns == ["v", "id"]
    assert sorted(map(tuple, got.select("id", "v").collect())) == sorted((f"k{n}", "2" if n % 5 == 0 else "0") for n in range(40))
    assert sorted(map(tuple, latest_per_key(table, ["id"], "version").select("v", "id").collect())) == sorted(map(tuple, got.collect()))
    # Rows of the other keys are not shuffled.
    assert ("LeftAnti" in got._jdf.queryExecution().executedPlan().toString()) == (max_rows > 0)
    once = latest_if_repeated(table.where("version = 0"), ["id"], F.col("version"), ("id",), max_rows)
    assert once.count() == 40


def test_compacting_twice_keeps_rows_without_a_key_once(spark):
    from tidewater.sinks.versioned import append_versions, compact, read_latest

    path = scratch_path(spark, "test-compact") + "/t"
    cols = "doc_id string, v string, version long, day string"
    batch = spark.createDataFrame([("a", "1", 1, "d1"), (None, "x", 5, "d1"), (None, "y", 5, "d1")], cols)
    append_versions(batch, path, "day")
    append_versions(batch, path, "day")  # a replay
    want = sorted((str(r["doc_id"]), r["v"]) for r in batch.collect())
    for _ in range(3):
        compact(spark, path, ["doc_id"], "version", "day")
        assert sorted((str(r["doc_id"]), r["v"]) for r in spark.read.parquet(path).collect()) == want
    assert read_latest(spark, path, ["doc_id"], "version").count() == 3
