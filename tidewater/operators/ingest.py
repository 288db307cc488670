"""Intake of raw logs and change records: stamp, route, decode.

Routing never splits the job in two: it adds a ``topic`` column, and a sink
writes the frame once, partitioned by topic (or a ``foreachBatch`` writes the
two filtered halves of one persisted batch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's: topic names.
TOPIC_STARTUP = "GMALL_STARTUP"
TOPIC_EVENT = "GMALL_EVENT"
TOPIC_ORDER_INFO = "GMALL_ORDER_INFO"
TOPIC_ORDER_DETAIL = "GMALL_ORDER_DETAIL"
TOPIC_USER_INFO = "GMALL_USER_INFO"
# Our topic for lines that are no JSON object.
TOPIC_QUARANTINE = "LOG_QUARANTINE"

# Change-record routing: (source table, accepted event types, topic).
CDC_ROUTES = (
    ("order_info", ("INSERT",), TOPIC_ORDER_INFO),
    ("order_detail", ("INSERT",), TOPIC_ORDER_DETAIL),
    ("user_info", ("INSERT", "UPDATE"), TOPIC_USER_INFO),
)

# On the change-record wire every value is a string; numbers are cast after
# decoding (a DOUBLE field in the JSON schema would turn "12.5" into null).
ORDER_WIRE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in (
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way", "user_id", "img_url",
    "total_amount", "expire_time", "delivery_address", "create_time", "operate_time", "tracking_no", "parent_order_id",
    "out_trade_no", "trade_body")])
ORDER_LINE_WIRE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in (
    "id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")])
USER_WIRE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in (
    "id", "login_name", "user_level", "birthday", "gender")])


def route_logs(raw: DataFrame, line_col: str = "line", received_col: str = "received_ms") -> DataFrame:
    """Raw log lines -> ``(topic, value)`` with the intake time put into ``ts``
    (replacing a client value).

    A line is parsed once, into a map of VARIANT values, so every other field
    stays with its type, known or not.  ``startup`` logs go to the startup
    topic, everything else (also a null or missing type) to the event topic.  Of a
    repeated field the last value counts.
    A line that is no JSON object, or null, goes to the quarantine topic with
    its text as it came.
    """
    rec, fields = F.col("_rec"), F.col("_fields")
    names = F.map_keys(rec)
    last = F.filter(F.map_entries(rec), lambda e, i: (e["key"] != "ts") & ~F.array_contains(
        F.slice(names, i + 2, F.size(names)), e["key"]))
    is_startup = F.coalesce(F.try_variant_get(fields["type"], "$", "string") == "startup", F.lit(False))
    topic = F.when(rec.isNull(), TOPIC_QUARANTINE).when(is_startup, TOPIC_STARTUP).otherwise(TOPIC_EVENT)
    stamped = F.map_concat(fields, F.create_map(F.lit("ts"), F.col(received_col).cast("long").cast("variant")))
    parsed = raw.withColumn("_rec", F.from_json(F.col(line_col), "map<string,variant>")).withColumn(
        "_fields", F.map_from_entries(last))
    value = F.when(rec.isNull(), F.col(line_col)).otherwise(F.to_json(stamped))
    # Behind a generate, a filter on the topic is not pushed into the parse, which would repeat it.
    kept = [c for c in raw.columns if c not in ("topic", "value")]
    return parsed.select(*kept, F.inline(F.array(F.struct(topic.alias("topic"), value.alias("value")))))


def cdc_topic(table: Column, event_type: Column) -> Column:
    out = None
    for tbl, events, topic in CDC_ROUTES:
        cond = (table == F.lit(tbl)) & event_type.isin(*events)
        out = F.when(cond, F.lit(topic)) if out is None else out.when(cond, F.lit(topic))
    return out


def route_changes(changes: DataFrame) -> DataFrame:
    """Keep row-data changes that have a route and encode the after-image.

    Rows of other tables, DELETEs, order UPDATEs and non-row entries are
    dropped, as in the reference.
    """
    routed = changes.where(F.col("entry_type") == "ROWDATA").withColumn(
        "topic", cdc_topic(F.col("table"), F.col("event_type"))
    )
    return routed.where(F.col("topic").isNotNull()).withColumn("value", F.to_json("after"))


def decode_orders(values: DataFrame, value_col: str = "value") -> DataFrame:
    """Order JSON (all strings) -> typed order rows with all fields; a field that is missing, or an
    amount that is no number, is null."""
    rec = F.from_json(F.col(value_col), ORDER_WIRE_SCHEMA)
    keep = [c for c in values.columns if c != value_col]
    typed = {"total_amount": F.col("_r.total_amount").try_cast("double").alias("total_amount")}
    return values.select(*keep, rec.alias("_r")).select(
        *keep, *[typed.get(f.name, F.col(f"_r.{f.name}")) for f in ORDER_WIRE_SCHEMA])


def decode_order_lines(values: DataFrame, value_col: str = "value") -> DataFrame:
    """Order-line JSON (all strings) -> typed order lines; a field that is missing, or a price
    or quantity that is no number, is null."""
    rec = F.from_json(F.col(value_col), ORDER_LINE_WIRE_SCHEMA)
    keep = [c for c in values.columns if c != value_col]
    return values.select(*keep, rec.alias("_r")).select(
        *keep, "_r.id", "_r.order_id", "_r.sku_name", "_r.sku_id",
        F.col("_r.order_price").try_cast("double").alias("order_price"), "_r.img_url",
        F.col("_r.sku_num").try_cast("long").alias("sku_num"))


def decode_users(values: DataFrame, value_col: str = "value") -> DataFrame:
    """User JSON (all strings) -> user rows; a birthday that is no ``yyyy-MM-dd`` day is null."""
    rec = F.from_json(F.col(value_col), USER_WIRE_SCHEMA)
    keep = [c for c in values.columns if c != value_col]
    return values.select(*keep, rec.alias("_r")).select(
        *keep, "_r.id", "_r.login_name", "_r.user_level",
        F.try_to_timestamp("_r.birthday", F.lit("yyyy-MM-dd")).cast("date").alias("birthday"), "_r.gender")


def latest_per_key(df: DataFrame, keys, version: str | Column, keep: str = "max", columns=None) -> DataFrame:
    """Newest row per key by ``version`` (a grouped ``max_by``: partial
    aggregation on the map side, no sort of the whole group).  ``keep="min"``
    keeps the oldest instead.  ``columns``: those of the result, so that no others are shuffled."""
    keys = list(keys)
    rest = [c for c in (df.columns if columns is None else columns) if c not in keys]
    pick = F.max_by if keep == "max" else F.min_by
    out = df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(version) if isinstance(version, str) else version).alias("_last"))
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])
