"""First days of keys against a recount after every batch, over replays and folds."""

import random
from collections import Counter

from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks.first_seen import PAGE_BITS, FirstSeen, _bit

ROWS = "mid string, logdate string"


def batches():
    random.seed(4)
    out = []
    for n in range(5):
        keys = random.sample(range(300), 120)
        # Later batches bring earlier days too; a key comes several times in a batch.
        rows = [(f"m{k}" if k else None, f"2024-01-{random.randint(1, 28):02d}") for k in keys + keys[:20]]
        out.append([*rows, (f"only{n}", None)])
    return out


def firsts(history):
    least = {}
    for batch in history:
        for key, day in batch:
            if day is not None and (key not in least or day < least[key]):
                least[key] = day
    return least


def check(spark, table, history):
    want = firsts(history)
    assert {r["logdate"]: r["n"] for r in table.new_by_day(spark).collect()} == Counter(want.values())
    assert {r["mid"]: r["logdate"] for r in table.first_days(spark).collect()} == want


def test_new_keys_by_day_after_every_batch(spark):
    table = FirstSeen(scratch_path(spark, "first-seen"), buckets=4, pages=2)
    history = batches()
    for n, batch in enumerate(history):
        for _ in range(2 if n in (0, 3) else 1):  # replays
            table.apply(spark.createDataFrame(batch, ROWS), n)
        check(spark, table, history[:n + 1])
        if n == 2:
            table.fold(spark, 1)
            table.fold(spark, 1)
            check(spark, table, history[:3])
    table.fold(spark, 4)
    check(spark, table, history)
    table.apply(spark.createDataFrame([], ROWS), 5)
    table.apply(spark.createDataFrame([("m1", "2023-12-31"), ("new", "2024-02-01")], ROWS), 6)
    check(spark, table, [*history, [("m1", "2023-12-31"), ("new", "2024-02-01")]])
    assert firsts(history)["m1"] != "2023-12-31"


def test_a_batch_of_new_keys_reads_few_buckets(spark):
    table = FirstSeen(scratch_path(spark, "first-seen"), buckets=8, pages=2)
    table.apply(spark.range(2000).select(F.concat(F.lit("old"), "id").alias("mid"), F.lit("2024-01-01").alias("logdate")), 0)

    def maybe(name, n):
        keys = table._placed(spark.range(n).select(F.concat(F.lit(name), "id").alias("mid"), F.lit("2024-01-02").alias("logdate")))
        return table._maybe_known(spark, keys, 1).where("maybe").count()

    assert maybe("old", 2000) == 2000  # a filter misses no key
    assert maybe("new", 2000) < 20


def test_full_filter_gives_the_same_answer(spark):
    # One page for 6,000 keys: most keys pass the filter and are looked up.
    table = FirstSeen(scratch_path(spark, "first-seen"), buckets=1, pages=1)
    for n in range(3):
        rows = spark.range(n * 3000, n * 3000 + 6000).select(F.col("id").cast("string").alias("mid"), F.lit(f"2024-01-0{n + 1}").alias("logdate"))
        table.apply(rows, n)
    assert {r["logdate"]: r["n"] for r in table.new_by_day(spark).collect()} == {
        "2024-01-01": 6000, "2024-01-02": 3000, "2024-01-03": 3000}


def test_bits_of_a_page(spark):
    at = [0, 7, 8, 1000, PAGE_BITS - 1]
    page = spark.createDataFrame([(a,) for a in at], "at long").agg(F.bitmap_construct_agg("at").alias("bits"))
    probes = spark.createDataFrame([(a,) for a in [*at, 1, 9, 999, PAGE_BITS - 2]], "at long")
    got = {r[0] for r in probes.crossJoin(page).where(_bit(F.col("bits"), F.col("at"))).select("at").collect()}
    assert got == set(at)
