"""Views that shape the driver's tables like the reference's inputs.

The driver ships TPC-H-like tables plus an ``events`` table; the reference's
jobs consume startup/event logs, order and order-line records, users and
change-data-capture records.  Each function below derives one of those inputs
from the driver tables with plain DataFrame operations, so the work of every
FIXTURES.md §4; the oracle SQL in :mod:`tidewater.plans.oracle` holds the same
mappings in DuckDB's dialect.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import date_part_of, day_bounds_ts, epoch_ms, format_datetime, hour_part_of
from tidewater.sources.tables import Tables

# Fixed values of the fixture mapping (shared with the oracle SQL).
DEVICES = 30                 # mid = 'mid_' || user_id % 30
AREAS = 10                   # area = 'area_' || user_id % 10
ORDER_SECOND_MULT = 7919     # create time = order date + (o_orderkey * 7919) % 86400 s
LINE_OFFSET_MOD = 400        # arrival = create time + ((k*31 + n*97) % 400 - 200) s
LINE_OFFSET_SHIFT = 200
USER_MISS_MOD = 7            # customers with c_custkey % 7 = 0 have no user row
BIRTHDAY_BASE = "1955-01-01"
BIRTHDAY_MULT = 37
BIRTHDAY_SPAN = 18000
BIRTHDAY_BROKEN_MOD = 10     # customers whose key this divides send no date as their birthday
# Product names in a script without spaces; words that are not here stay as they are.
HAN_WORDS = {
    "red": "红色", "blue": "蓝色", "small": "小号", "large": "大号", "hot": "热", "cold": "冷", "old": "旧", "new": "新",
    "gear": "齿轮", "ring": "戒指", "plate": "盘子", "anvil": "铁砧", "bolt": "螺栓", "rod": "杆",
}
# Columns that the views of orders and of lines read.
ORDER_SOURCE = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
LINE_SOURCE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
EVID_OF = {"purchase": "coupon", "click": "clickItem", "signup": "addFavor", "error": "addComment"}


def _evid(event_type: Column) -> Column:
    out = None
    for src, dst in EVID_OF.items():
        out = (F.when(event_type == src, dst) if out is None else out.when(event_type == src, dst))
    return out


def _events(t: Tables, ts_from=None, ts_to=None) -> DataFrame:
    """The raw event rows.  ``ts_from``/``ts_to`` (naive UTC datetimes, half-open) restrict the scan of
    the raw table; the predicate reaches the parquet reader, which is how a
    query of one day skips the rest (the role of a date partition).
    """
    ev = t.events
    if ts_from is not None:
        ev = ev.where(F.col("ts") >= F.lit(ts_from))
    if ts_to is not None:
        ev = ev.where(F.col("ts") < F.lit(ts_to))
    return ev


def v_log(t: Tables, ts_from=None, ts_to=None) -> DataFrame:
    """Decoded startup and event logs (one row per driver event)."""
    return _logs_of(_events(t, ts_from, ts_to))


def _logs_of(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("log_id"),
        F.when(F.col("event_type") == "view", "startup").otherwise("event").alias("type"),
        F.concat(F.lit("mid_"), (F.col("user_id") % DEVICES).cast("string")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.concat(F.lit("area_"), (F.col("user_id") % AREAS).cast("string")).alias("area"),
        epoch_ms("ts").alias("ts"),
        _evid(F.col("event_type")).alias("evid"),
        F.get_json_object("props", "$.k").alias("itemid"),
    )


def v_startup(t: Tables, ts_from=None, ts_to=None) -> DataFrame:
    # Filtered on the raw column, so the predicate reaches the parquet scan.
    return _logs_of(_events(t, ts_from, ts_to).where(F.col("event_type") == "view"))


def v_event(t: Tables, ts_from=None, ts_to=None) -> DataFrame:
    return _logs_of(_events(t, ts_from, ts_to).where(~F.col("event_type").eqNullSafe("view")))


def v_raw_log(t: Tables, broken_every: int | None = None) -> DataFrame:
    """Raw log lines as the collector receives them: JSON text without ``ts``
    (the intake adds it), with a number (``seq``), and the time the line was
    received.  ``broken_every``: lines whose id it divides lose their last
    character, so they are no JSON."""
    logs = v_log(t)
    line = F.to_json(F.struct("type", "mid", "uid", "area", "evid", "itemid", F.col("log_id").alias("seq")))
    if broken_every:
        line = F.when(F.col("log_id") % broken_every == 0, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    return logs.select("log_id", line.alias("line"), F.col("ts").alias("received_ms"))


def v_order(t: Tables, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Order records with a create time, masked-phone source and province.

    ``date_from``/``date_to`` (``yyyy-MM-dd``, half-open on ``create_date``)
    restrict the scan: the create time lies within a day after the order
    date, so ``o_orderdate`` in ``(date_from - 1 day, date_to)`` is a safe
    predicate that the parquet reader can use.
    """
    o = t.orders.select(*ORDER_SOURCE)
    if date_from is not None:
        lo, _ = day_bounds_ts(date_from)
        o = o.where(F.col("o_orderdate") > F.lit(lo - _dt.timedelta(days=1)))
    if date_to is not None:
        hi, _ = day_bounds_ts(date_to)
        o = o.where(F.col("o_orderdate") < F.lit(hi))
    c = t.customer.select("c_custkey", "c_nationkey")
    create_ts = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), ((F.col("o_orderkey") * ORDER_SECOND_MULT) % 86400).cast("decimal(18,6)")
    )
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner")
    base = joined.select(
        F.col("o_orderkey").cast("string").alias("id"),
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("user_id"),
        create_ts.alias("create_ts"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.concat(F.lit("138"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("consignee_tel"),
        F.col("c_nationkey").cast("string").alias("province_id"),
    )
    ct = format_datetime("create_ts")
    return base.select(
        "*",
        ct.alias("create_time"),
        date_part_of(ct).alias("create_date"),
        hour_part_of(ct).alias("create_hour"),
    )


def v_detail(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Order lines with a sku name and an arrival time near their order's."""
    li = t.lineitem.select(*LINE_SOURCE)
    p = t.part.select("p_partkey", "p_name")
    # Joined on the string order id, the key the sale-detail join uses as
    # well: the lines come out of this join already hash-partitioned by it,
    # so the later order/line join does not shuffle the largest table again.
    o = (orders if orders is not None else v_order(t)).select(
        F.col("id").alias("order_id"), F.col("create_ts").alias("_cts")
    )
    offset = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 97) % LINE_OFFSET_MOD - LINE_OFFSET_SHIFT
    arrival = F.col("_cts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset.cast("decimal(18,6)"))
    return (
        li.join(p, li.l_partkey == p.p_partkey, "inner")
        .join(o, F.col("l_orderkey").cast("string") == F.col("order_id"), "inner")
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
            "order_id",
            F.col("l_partkey").cast("string").alias("sku_id"),
            F.col("p_name").alias("sku_name"),
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("order_price"),
            "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber",
            arrival.alias("arrival_ts"),
        )
    )


def v_product_han(t: Tables) -> DataFrame:
    """Products with a name without spaces (``HAN_WORDS``)."""
    han = F.create_map(*[F.lit(x) for pair in HAN_WORDS.items() for x in pair])
    words = F.transform(F.split("p_name", " "), lambda w: F.coalesce(han[w], w))
    return t.part.select(F.col("p_partkey").cast("string").alias("sku_id"), F.array_join(words, "").alias("sku_name"))


def v_user(t: Tables) -> DataFrame:
    """User dimension: gender F/M/null, a birthday, level; some customers missing."""
    c = t.customer.select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    return c.where(k % USER_MISS_MOD != 0).select(
        k.cast("string").alias("id"),
        F.when(k % 3 == 0, "F").when(k % 3 == 1, "M").alias("gender"),
        F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), ((k * BIRTHDAY_MULT) % BIRTHDAY_SPAN).cast("int")).alias("birthday"),
        F.col("c_mktsegment").alias("user_level"),
    )


def v_user_history(t: Tables) -> DataFrame:
    """Versions of the users with the time they became valid: users come to be between
    1988 and 1993; some change their level twice later."""
    users = v_user(t).withColumn("k", F.col("id").cast("long"))

    def since(day: str, span: int) -> Column:
        return F.timestamp_seconds(F.unix_timestamp(F.lit(day).cast("timestamp")) + (F.col("k") * 86_413) % (span * 86_400))

    first = users.withColumn("valid_from", since("1988-01-01", 2000))
    second = users.where("k % 4 = 1").withColumn("user_level", F.lower("user_level")).withColumn(
        "valid_from", since("1994-01-01", 700))
    third = users.where("k % 8 = 1").withColumn("user_level", F.concat(F.lit("vip "), "user_level")).withColumn(
        "valid_from", since("1996-01-01", 700))
    return first.unionByName(second).unionByName(third).drop("k")


# --- change-data-capture feed -------------------------------------------------

def _event_type(key: Column) -> Column:
    m = key % 5
    return F.when(m == 3, "UPDATE").when(m == 4, "DELETE").otherwise("INSERT")


def _entry_type(key: Column) -> Column:
    return F.when(key % 17 == 0, "TRANSACTIONEND").otherwise("ROWDATA")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def v_cdc(t: Tables) -> DataFrame:
    """Row changes of four source tables; every after-image value is a string.

    ``seq`` orders the changes of one key; ``after`` is the row's after-image.
    """
    o = t.orders
    ok = F.col("o_orderkey")
    orders = o.select(
        F.lit("order_info").alias("table"),
        _entry_type(ok).alias("entry_type"),
        _event_type(ok).alias("event_type"),
        (ok * 10).alias("seq"),
        F.create_map(
            F.lit("id"), _s(ok),
            F.lit("user_id"), _s("o_custkey"),
            F.lit("total_amount"), _money("o_totalprice"),
            F.lit("order_status"), F.col("o_orderstatus"),
            F.lit("consignee_tel"), F.concat(F.lit("138"), F.lpad(_s("o_custkey"), 8, "0")),
            F.lit("create_time"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
            F.lit("consignee"), F.concat(F.lit("Customer "), _s("o_custkey")),
            F.lit("payment_way"), _s(F.col("o_custkey") % 3),
            F.lit("out_trade_no"), F.concat(F.lit("T"), _s(ok)),
            F.lit("trade_body"), F.col("o_orderpriority"),
            F.lit("expire_time"), F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"),
        ).alias("after"),
    )
    li = t.lineitem
    lk = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    details = li.select(
        F.lit("order_detail").alias("table"),
        _entry_type(lk).alias("entry_type"),
        _event_type(lk).alias("event_type"),
        (lk * 10).alias("seq"),
        F.create_map(
            F.lit("id"), F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")),
            F.lit("order_id"), _s("l_orderkey"),
            F.lit("sku_id"), _s("l_partkey"),
            F.lit("order_price"), _money("l_extendedprice"),
            F.lit("sku_num"), F.col("l_quantity").cast("int").cast("string"),
        ).alias("after"),
    )
    c = t.customer
    ck = F.col("c_custkey")
    born = F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), ((ck * BIRTHDAY_MULT) % BIRTHDAY_SPAN).cast("int"))
    birthday = F.when(ck % BIRTHDAY_BROKEN_MOD != 0, F.date_format(born, "yyyy-MM-dd")).otherwise("unknown")
    user_after = lambda level: F.create_map(
        F.lit("id"), _s(ck),
        F.lit("login_name"), F.col("c_name"),
        F.lit("user_level"), level,
        F.lit("gender"), F.when(ck % 3 == 0, "F").when(ck % 3 == 1, "M"),
        F.lit("birthday"), birthday,
    )
    users_insert = c.select(
        F.lit("user_info").alias("table"),
        _entry_type(ck).alias("entry_type"),
        F.lit("INSERT").alias("event_type"),
        (ck * 10).alias("seq"),
        user_after(F.col("c_mktsegment")).alias("after"),
    )
    users_change = c.where(ck % 4 == 1).select(
        F.lit("user_info").alias("table"),
        F.lit("ROWDATA").alias("entry_type"),
        F.when(ck % 3 == 2, "DELETE").otherwise("UPDATE").alias("event_type"),
        (ck * 10 + 5).alias("seq"),
        user_after(F.lower("c_mktsegment")).alias("after"),
    )
    n = t.nation
    nk = F.col("n_nationkey")
    provinces = n.select(
        F.lit("base_province").alias("table"),
        F.lit("ROWDATA").alias("entry_type"),
        F.lit("INSERT").alias("event_type"),
        (nk * 10).alias("seq"),
        F.create_map(F.lit("id"), _s(nk), F.lit("name"), F.col("n_name")).alias("after"),
    )
    return orders.unionByName(details).unionByName(users_insert).unionByName(users_change).unionByName(provinces)
