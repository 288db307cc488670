import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import joins, sales, search, serving

ORDER_COLS = "id string, order_status string, create_time string, user_id string, create_date string, create_ts timestamp"
LINE_COLS = "id string, order_id string, sku_id string, sku_name string, order_price string, arrival_ts timestamp"
T = dt.datetime(2020, 5, 22, 0, 52, 43)


def orders(spark, rows=None):
    rows = rows or [("o1", "1", "2020-05-22 00:52:43", "u1", "2020-05-22", T)]
    return spark.createDataFrame(rows, ORDER_COLS)


def test_interval_join_bound(spark):
    lines = spark.createDataFrame([
        ("d60", "o1", "s", "red ring", "10.5", T + dt.timedelta(seconds=60)),
        ("d120", "o1", "s", "red ring", "10.5", T + dt.timedelta(seconds=120)),
        ("d180", "o1", "s", "red ring", "10.5", T + dt.timedelta(seconds=180)),
        ("dm60", "o1", "s", "red ring", "10.5", T - dt.timedelta(seconds=60)),
    ], LINE_COLS)
    got = sorted(r["order_detail_id"] for r in sales.interval_join(orders(spark), lines).collect())
    assert got == ["d120", "d60", "dm60"]


def test_full_outer_keeps_unmatched(spark):
    lines = spark.createDataFrame([("d1", "o9", "s", "x", "1.0", T)], LINE_COLS)
    assert sales.full_outer_join(orders(spark), lines).count() == 2


def test_user_miss_defaults(spark):
    lines = spark.createDataFrame([("d1", "o1", "s", "red ring", "10.5", T)], LINE_COLS)
    wide = sales.interval_join(orders(spark), lines)
    users = spark.createDataFrame([], "id string, gender string, birthday date, user_level string")
    row = sales.enrich_with_users(wide, users, "2024-01-01").first()
    assert row["user_age"] == 0 and row["user_gender"] is None and row["sku_price"] == 10.5


def test_shares_no_female_bucket(spark):
    found = spark.createDataFrame([(25, "M"), (10, None), (40, "M")], "user_age int, user_gender string")
    rows = {(r["title"], r["name"]): r["value"] for r in search.age_gender_shares(found).collect()}
    assert rows[("用户性别占比", "女")] == 0.0
    assert rows[("用户性别占比", "男")] == 100.0
    assert rows[("用户年龄占比", "20岁以下")] == 33.3
    assert rows[("用户年龄占比", "20岁到30岁")] == 33.3
    assert rows[("用户年龄占比", "30岁及30岁以上")] == 33.400000000000006


def test_shares_empty_answer(spark):
    found = spark.createDataFrame([], "user_age int, user_gender string")
    assert search.age_gender_shares(found).count() == 0


def test_hour_densify(spark):
    per_hour = spark.createDataFrame([("2024-01-02", "03", 5), ("2024-01-02", "17", 2), ("2024-01-01", "03", 1)],
                                     "d string, h string, v long")
    out = {r["hour"]: (r["today"], r["yesterday"]) for r in
           serving.today_vs_yesterday(spark, per_hour, "2024-01-02", "d", "h", "v").collect()}
    assert len(out) == 24 and out["03"] == (5, 1) and out["17"] == (2, 0) and out["00"] == (0, 0)


def test_join_demo(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1)], "k string, lv int")
    right = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("d", 1)], "k string, rv int")

    def rows(how):
        return sorted(tuple(r) for r in joins.pair_join(left, right, ["k"], how).collect())

    inner = [("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("b", 1, 2)]
    assert rows("inner") == inner
    assert rows("left") == sorted(inner + [("c", 1, None)])
    assert rows("right") == sorted(inner + [("d", None, 1)])
    assert rows("full") == sorted(inner + [("c", 1, None), ("d", None, 1)])


def test_bm25_prefers_shorter_and_rarer(spark):
    corpus = spark.createDataFrame(
        [("d1", "red ring"), ("d2", "red ring large heavy"), ("d3", "blue bolt"), ("d4", "red bolt")],
        "doc_id string, sku_name string")
    found = corpus.where(F.col("sku_name").contains("ring"))
    scored = {r["doc_id"]: r["score"] for r in search.bm25_scores(corpus, found, "red ring").collect()}
    assert scored["d1"] > scored["d2"] > 0
    page = search.ranked_page(search.bm25_scores(corpus, corpus, "red"), 1, 2).collect()
    assert [r["doc_id"] for r in page][0] in ("d1", "d4")


def test_sale_detail_answer_shape(spark):
    import json

    found = spark.createDataFrame(
        [("d1", "red ring", 25, "F"), ("d2", "red rod", 10, None), ("d3", "red gear", 40, "M")],
        "doc_id string, sku_name string, user_age int, user_gender string")
    shares = search.age_gender_shares(found)
    page = search.ranked_page(search.bm25_scores(found, found, "red"), 1, 2).select("doc_id")
    answer = json.loads(search.sale_detail_answer(shares, page, found).first()["json"])
    assert answer["total"] == 3
    assert [s["title"] for s in answer["stat"]] == ["用户年龄占比", "用户性别占比"]
    assert [o["name"] for o in answer["stat"][1]["options"]] == ["男", "女"]
    assert answer["stat"][1]["options"][1]["value"] == 33.3
    assert len(answer["detail"]) == 2
    empty = found.where("false")
    assert search.sale_detail_answer(search.age_gender_shares(empty), page.where("false"), empty).first()["json"] == "{}"


def test_lean_corpus_equals_sale_table_names(spark):
    from tests.conftest import SF_SMALL
    from tidewater.plans import catalog

    lean = catalog._sale_corpus(spark, SF_SMALL)
    full = catalog._sale_table(spark, SF_SMALL).select("doc_id", "sku_name")
    assert lean.count() == full.count()
    assert lean.exceptAll(full).count() == 0
    assert full.exceptAll(lean).count() == 0


def test_shares_when_most_genders_are_null(spark):
    from tidewater.operators.search import age_gender_shares

    found = spark.createDataFrame([(25, None)] * 5 + [(18, "M")] * 3 + [(40, "F")] * 2, "user_age int, user_gender string")
    shares = {r["pos"]: r["value"] for r in age_gender_shares(found).collect()}
    assert shares == {1: 30.0, 2: 50.0, 3: 20.0, 4: 80.0, 5: 20.0}
