import json

from pyspark.sql import functions as F

from tidewater.operators import ingest


def test_log_route_and_stamp(spark):
    df = spark.createDataFrame([
        (1, '{"type":"startup","mid":"m1","ts":5}', 1000),
        (2, '{"type":"event","mid":"m1","evid":"coupon"}', 2000),
        (3, '{"mid":"m2"}', 3000),
    ], "id long, line string, received_ms long")
    out = {r["id"]: r for r in ingest.route_logs(df).collect()}
    assert out[1]["topic"] == ingest.TOPIC_STARTUP
    assert out[2]["topic"] == ingest.TOPIC_EVENT and out[3]["topic"] == ingest.TOPIC_EVENT
    assert json.loads(out[1]["value"]) == {"type": "startup", "mid": "m1", "ts": 1000}
    assert json.loads(out[2]["value"])["ts"] == 2000


def test_cdc_filter(spark):
    after = F.create_map(F.lit("id"), F.lit("1"))
    df = spark.createDataFrame([
        ("order_info", "ROWDATA", "INSERT"), ("order_info", "ROWDATA", "UPDATE"),
        ("user_info", "ROWDATA", "UPDATE"), ("user_info", "ROWDATA", "DELETE"),
        ("base_province", "ROWDATA", "INSERT"), ("order_info", "TRANSACTIONEND", "INSERT"),
    ], "table string, entry_type string, event_type string").withColumn("after", after)
    out = ingest.route_changes(df).select("table", "event_type", "topic", "value").collect()
    assert sorted((r["table"], r["event_type"], r["topic"]) for r in out) == [
        ("order_info", "INSERT", ingest.TOPIC_ORDER_INFO), ("user_info", "UPDATE", ingest.TOPIC_USER_INFO)]
    assert {r["value"] for r in out} == {'{"id":"1"}'}


def test_order_lines(spark):
    values = [
        (1, '{"id":"7","order_id":"3","sku_name":"tea","sku_id":"9","order_price":"12.50","img_url":"u","sku_num":"2"}'),
        (2, '{"id":"8","order_id":"3","order_price":"free","sku_num":"","other":"x"}'), (3, "no json"), (4, None)]
    out = [tuple(r) for r in ingest.decode_order_lines(spark.createDataFrame(values, "seq long, value string")).orderBy("seq").collect()]
    assert out == [
        (1, "7", "3", "tea", "9", 12.5, "u", 2), (2, "8", "3", None, None, None, None, None), (3, *[None] * 7), (4, *[None] * 7)]


def test_orders_with_all_fields(spark):
    names = [f.name for f in ingest.ORDER_WIRE_SCHEMA]
    assert len(names) == 18
    full = json.dumps({n: "12.50" if n == "total_amount" else f"{n} text" for n in names} | {"other": "x"})
    values = [(1, full), (2, '{"id":"7","total_amount":"much"}'), (3, "no json"), (4, None)]
    out = ingest.decode_orders(spark.createDataFrame(values, "seq long, value string")).orderBy("seq").collect()
    assert out[0].asDict() == {"seq": 1} | {n: 12.5 if n == "total_amount" else f"{n} text" for n in names}
    assert out[1].asDict() == {"seq": 2} | dict.fromkeys(names) | {"id": "7"}
    assert out[2].asDict() == {"seq": 3} | dict.fromkeys(names) and out[3].asDict() == {"seq": 4} | dict.fromkeys(names)


def test_birthday_text_of_users(spark):
    values = [(i, json.dumps({"id": "1", "birthday": b})) for i, b in enumerate(["1970-02-28", "1971-02-30", "unknown", "", None])]
    out = ingest.decode_users(spark.createDataFrame(values, "seq long, value string")).orderBy("seq").collect()
    assert [str(r["birthday"]) for r in out] == ["1970-02-28", "None", "None", "None", "None"]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("1", "a", 10), ("1", "b", 15), ("2", "c", 1)], "id string, v string, seq long")
    out = {r["id"]: r["v"] for r in ingest.latest_per_key(df, ["id"], "seq").collect()}
    assert out == {"1": "b", "2": "c"}


def test_unknown_fields_and_number_types_are_kept(spark):
    line = '{"type":"event","pgid":7,"price":1.5,"extra":{"a":[1,null]},"gone":null,"ts":"old"}'
    df = spark.createDataFrame([(line, 9)], "line string, received_ms long")
    row = ingest.route_logs(df).collect()[0]
    assert row["topic"] == ingest.TOPIC_EVENT
    out = json.loads(row["value"])
    assert out["pgid"] == 7 and out["price"] == 1.5 and out["extra"] == {"a": [1, None]}
    assert out["ts"] == 9 and row["value"].count('"ts"') == 1


def test_malformed_lines_go_to_quarantine_with_their_text(spark):
    bad = ['{"type":"startup"', "not json", "[1]", "7", "", None]
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(bad)], "id long, line string, received_ms long")
    out = {r["id"]: (r["topic"], r["value"]) for r in ingest.route_logs(df).collect()}
    assert out == {i: (ingest.TOPIC_QUARANTINE, x) for i, x in enumerate(bad)}


def test_the_last_value_of_a_repeated_field_counts(spark):
    df = spark.createDataFrame([('{"type":"event","a":1,"a":2}', 1)], "line string, received_ms long")
    row = ingest.route_logs(df).collect()[0]
    assert row["topic"] == ingest.TOPIC_EVENT and row["value"] == '{"type":"event","a":2,"ts":1}'
