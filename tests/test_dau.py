from pyspark.sql import functions as F

from tidewater.operators import dau

COLS = "log_id long, type string, mid string, uid string, area string, ts long, evid string, itemid string"
DAY = 1704067200000  # 2024-01-01T00:00:00Z


def logs(spark, rows):
    return spark.createDataFrame(
        [(i, "startup", mid, uid, "a", ts, None, None) for i, (mid, uid, ts) in enumerate(rows)], COLS
    )


def test_first_per_day_picks_min_ts(spark):
    df = logs(spark, [("m1", "u1", DAY + 5), ("m1", "u2", DAY + 3), ("m1", "u3", DAY + 9)])
    out = dau.first_start_per_day(df).collect()
    assert len(out) == 1 and out[0]["ts"] == DAY + 3 and out[0]["uid"] == "u2"


def test_same_mid_two_days_both_kept(spark):
    df = logs(spark, [("m1", "u1", DAY + 5), ("m1", "u1", DAY + 86_400_000 + 5)])
    out = dau.first_start_per_day(df).orderBy("logdate").collect()
    assert [r["logdate"] for r in out] == ["2024-01-01", "2024-01-02"]


def test_ties_on_ts_are_broken_by_uid(spark):
    df = logs(spark, [("m1", "u9", DAY), ("m1", "u1", DAY)])
    assert dau.first_start_per_day(df).first()["uid"] == "u1"


def test_anti_join_drops_seen_pairs(spark):
    df = dau.with_log_time(logs(spark, [("m1", "u1", DAY), ("m2", "u2", DAY), ("m1", "u1", DAY + 86_400_000)]))
    seen = spark.createDataFrame([("m1", "2024-01-01")], "mid string, logdate string")
    out = sorted((r["mid"], r["logdate"]) for r in dau.drop_seen(df, seen).collect())
    assert out == [("m1", "2024-01-02"), ("m2", "2024-01-01")]


def test_totals_and_new_devices(spark):
    df = dau.first_start_per_day(logs(spark, [
        ("m1", "u1", DAY + 3_600_000), ("m2", "u2", DAY + 3_600_000 * 3), ("m1", "u1", DAY + 86_400_000),
    ]))
    assert dau.dau_total(df, "2024-01-01").first()["dau"] == 2
    assert dau.dau_total(df, "1999-01-01").first()["dau"] == 0
    hours = {r["loghour"]: r["ct"] for r in dau.dau_by_hour(df, "2024-01-01").collect()}
    assert hours == {"01": 1, "03": 1}
    new = {r["logdate"]: r["new_mid"] for r in dau.new_devices_by_day(df).collect()}
    assert new == {"2024-01-01": 2}
    assert dau.new_devices_on(df, "2024-01-02").first()["new_mid"] == 0
