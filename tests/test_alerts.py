from tidewater.operators import alerts

COLS = "mid string, uid string, evid string, itemid string, ts long"
T0 = 1704110410000  # 2024-01-01 12:00:10 UTC


def ev(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_alert_fires_with_three_accounts(spark):
    df = ev(spark, [("m1", "a", "coupon", "i1", T0), ("m1", "b", "coupon", "i2", T0 + 1000),
                    ("m1", "c", "coupon", "i1", T0 + 2000), ("m1", "a", "addCart", None, T0 + 2500)])
    out = alerts.coupon_alerts(df).collect()
    assert out, "expected alerts"
    assert {r["uids"] for r in out} == {"a,b,c"}
    assert {r["item_ids"] for r in out} == {"i1,i2"}
    assert {r["events"] for r in out} == {"addCart:1,coupon:3"}
    latest = alerts.latest_alert_per_doc(alerts.coupon_alerts(df)).collect()
    assert len(latest) == 1 and latest[0]["doc_id"] == "m1-12:00"
    assert latest[0]["ts"] == max(r["ts"] for r in out)


def test_click_blocks_alert(spark):
    df = ev(spark, [("m1", "a", "coupon", "i1", T0), ("m1", "x", "clickItem", "i9", T0 + 500),
                    ("m1", "b", "coupon", "i2", T0 + 1000), ("m1", "c", "coupon", "i1", T0 + 2000)])
    assert alerts.coupon_alerts(df).count() == 0


def test_same_account_three_times_is_below_threshold(spark):
    df = ev(spark, [("m1", "a", "coupon", "i1", T0 + k * 1000) for k in range(3)])
    assert alerts.coupon_alerts(df).count() == 0


def test_suppression_keeps_later_alert_of_a_minute(spark):
    rows = alerts.alert_doc_ids(spark.createDataFrame(
        [("m1", "2024", "2024", "a,b,c", "", "coupon:3", T0), ("m1", "2024", "2024", "a,b,d", "", "coupon:3", T0 + 20000)],
        "mid string, window_start string, window_end string, uids string, item_ids string, events string, ts long",
    ))
    latest = alerts.latest_alert_per_doc(rows.drop("day", "doc_id")).collect()
    assert len(latest) == 1 and latest[0]["uids"] == "a,b,d"


def test_panes_equal_direct_window_assignment(spark):
    """Window assembly from panes equals Spark's own sliding windows, also
    when the size is not a multiple of the slide."""
    from pyspark.sql import functions as F

    rows = [("m1", f"u{k % 5}", ["coupon", "addCart", "clickItem"][k % 3], f"i{k % 2}", T0 + k * 1700)
            for k in range(60)]
    df = alerts.with_event_time(ev(spark, rows))
    for window, slide in (("30 seconds", "5 seconds"), ("7 seconds", "3 seconds")):
        direct = df.groupBy(F.window("event_ts", window, slide).alias("w"), "mid", "evid").agg(
            F.count(F.lit(1)).alias("n"),
            F.array_sort(F.collect_set(F.when(F.col("evid") == "coupon", F.col("uid")))).alias("uids"))
        panes = alerts.window_evid_counts(df, window, slide).select(
            "w", "mid", "evid", "n", F.array_sort("uids").alias("uids"))
        assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, panes.collect()))
