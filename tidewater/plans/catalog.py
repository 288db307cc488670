"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key,
each paired with the DuckDB SQL that computes the same answer.

Every key reads the driver's whole tables (through the fixture views) and
returns a DataFrame; nothing is collected.  Parameters (dates, keyword, window
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import day_after, day_before, day_bounds_ts, script_keyword_tokens, script_tokens
from tidewater.operators import alerts as alert_ops
from tidewater.operators import dau as dau_ops
from tidewater.operators import gmv as gmv_ops
from tidewater.operators import ingest
from tidewater.operators import joins as join_ops
from tidewater.operators import sales as sale_ops
from tidewater.operators import search as search_ops
from tidewater.operators import serving
from tidewater.plans.oracle import with_views
from tidewater.plans.strategy import broadcast_if_few
from tidewater.session import checkpoint_root, scratch_path
from tidewater.sinks import files as file_sinks
from tidewater.sinks import postings
from tidewater.sinks.versioned import append_versions, compact, read_latest
from tidewater.sources import arrivals as feeds
from tidewater.sources import change_feed
from tidewater.sources import fixtures as fx
from tidewater.sources.tables import Tables
from tidewater.streaming import caches, dashboard, outer_join, stage_counts
from tidewater.streaming import jobs as stream_jobs

DAU_DATE = "2024-01-15"
GMV_DATE = "1997-05-28"
AGE_ASOF = "2001-08-01"
SEARCH_DT = "1997-05-20"
SEARCH_KEYWORD = "red"
BM25_KEYWORD = "red ring"
SEARCH_PAGE = 2
SEARCH_PAGE_SIZE = 5
ALERT_WINDOW = "6 hours"
ALERT_SLIDE = "1 hour"
SEEN_BEFORE_HOUR = "12"


@dataclass(frozen=True)
class QuerySpec:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name}")
        REGISTRY[name] = QuerySpec(name, fn, sql)
        return fn

    return wrap


# --- DAU ------------------------------------------------------------------------

def _dau_table(spark: SparkSession, sf_dir: str, date: str | None = None, days: int = 1) -> DataFrame:
    """DAU rows, optionally only of ``days`` days from ``date`` (scan pruned)."""
    t = Tables(spark, sf_dir)
    if date is None:
        return dau_ops.first_start_per_day(fx.v_startup(t))
    lo, hi = day_bounds_ts(date, days)
    return dau_ops.first_start_per_day(fx.v_startup(t, lo, hi))


@register("startup_first_per_day", with_views("v_dau") + "select * from v_dau")
def q_startup_first_per_day(spark, sf_dir):
    return _dau_table(spark, sf_dir)


@register("dau_anti_seen", with_views("v_startup") + f"""
    select s.log_id, s.mid, s.uid, s.ts, s.logdate, s.loghour from v_startup s
    where not exists (select 1 from v_startup m
                      where m.loghour < '{SEEN_BEFORE_HOUR}' and m.mid = s.mid and m.logdate = s.logdate)""")
def q_dau_anti_seen(spark, sf_dir):
    logs = dau_ops.with_log_time(fx.v_startup(Tables(spark, sf_dir)))
    seen = dau_ops.seen_pairs(logs.where(F.col("loghour") < SEEN_BEFORE_HOUR))
    return dau_ops.drop_seen(logs, seen).select("log_id", "mid", "uid", "ts", "logdate", "loghour")


@register("dau_total", with_views("v_dau") + f"select count(*) as dau from v_dau where logdate = '{DAU_DATE}'")
def q_dau_total(spark, sf_dir):
    return dau_ops.dau_total(_dau_table(spark, sf_dir, DAU_DATE), DAU_DATE)


@register("dau_by_hour", with_views("v_dau") + f"""
    select loghour, count(*) as ct from v_dau where logdate = '{DAU_DATE}' group by loghour""")
def q_dau_by_hour(spark, sf_dir):
    return dau_ops.dau_by_hour(_dau_table(spark, sf_dir, DAU_DATE), DAU_DATE)


@register("new_devices_by_day", with_views("v_dau") + """
    select logdate, count(*) as new_mid
    from (select mid, min(logdate) as logdate from v_dau group by mid) group by logdate""")
def q_new_devices_by_day(spark, sf_dir):
    return dau_ops.new_devices_by_day(_dau_table(spark, sf_dir))


# --- GMV ------------------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    """Enriched orders; with ``date`` only orders that can fall on that day
    are read (the predicate reaches the parquet scan)."""
    t = Tables(spark, sf_dir)
    src = fx.v_order(t) if date is None else fx.v_order(t, date, day_after(date))
    return gmv_ops.enrich_orders(src).select(*gmv_ops.ORDER_COLUMNS)


@register("order_enriched", with_views("v_order_enriched") + "select * from v_order_enriched")
def q_order_enriched(spark, sf_dir):
    return _orders(spark, sf_dir)


@register("gmv_total", with_views("v_order_enriched") + f"""
    select round(cast(sum(total_amount) as double), 2) as sum_amount
    from v_order_enriched where create_date = '{GMV_DATE}'""")
def q_gmv_total(spark, sf_dir):
    out = gmv_ops.gmv_total(_orders(spark, sf_dir, GMV_DATE), GMV_DATE)
    return out.select(F.round("sum_amount", 2).alias("sum_amount"))


@register("gmv_by_hour", with_views("v_order_enriched") + f"""
    select create_hour, round(cast(sum(total_amount) as double), 2) as sum_amount
    from v_order_enriched where create_date = '{GMV_DATE}' group by create_hour""")
def q_gmv_by_hour(spark, sf_dir):
    out = gmv_ops.gmv_by_hour(_orders(spark, sf_dir, GMV_DATE), GMV_DATE)
    return out.select("create_hour", F.round("sum_amount", 2).alias("sum_amount"))


@register("gmv_by_province", with_views("v_order_enriched") + f"""
    select province_id, count(*) as order_count, round(sum(total_amount), 2) as order_amount,
           cast(count(*) // {gmv_ops.PROVINCE_BAND} as integer) as band
    from v_order_enriched group by province_id""")
def q_gmv_by_province(spark, sf_dir):
    out = gmv_ops.gmv_by_province(_orders(spark, sf_dir))
    return out.withColumn("order_amount", F.round("order_amount", 2))


# --- intake and change records -----------------------------------------------------

@register("log_route", with_views("v_log_routed") + "select log_id, topic, value from v_log_routed")
def q_log_route(spark, sf_dir):
    raw = fx.v_raw_log(Tables(spark, sf_dir))
    return ingest.route_logs(raw).select("log_id", "topic", "value")


# Lines whose id this divides arrive broken in the quarantine query.
BROKEN_EVERY = 50


@register("log_quarantine", with_views("v_raw_log") + f"""
    select log_id, '{ingest.TOPIC_QUARANTINE}' as topic, left(line, length(line) - 1) as value
    from v_raw_log where log_id % {BROKEN_EVERY} = 0""")
def q_log_quarantine(spark, sf_dir):
    raw = fx.v_raw_log(Tables(spark, sf_dir), broken_every=BROKEN_EVERY)
    routed = ingest.route_logs(raw)
    return routed.where(F.col("topic") == ingest.TOPIC_QUARANTINE).select("log_id", "topic", "value")


@register("cdc_route", with_views("v_cdc_routed") + 'select "table", seq, topic, value from v_cdc_routed')
def q_cdc_route(spark, sf_dir):
    return ingest.route_changes(fx.v_cdc(Tables(spark, sf_dir))).select("table", "seq", "topic", "value")


def _order_fields_sql() -> str:
    def field(name: str) -> str:
        text = f"json_extract_string(value, '$.{name}')"
        return f"{f'try_cast({text} as double)' if name == 'total_amount' else text} as {name}"

    return ", ".join(field(f.name) for f in ingest.ORDER_WIRE_SCHEMA)


@register("json_decode_cast", with_views("v_cdc_routed") + f"""
    select seq, {_order_fields_sql()}
    from v_cdc_routed where topic = '{ingest.TOPIC_ORDER_INFO}'""")
def q_json_decode_cast(spark, sf_dir):
    routed = ingest.route_changes(fx.v_cdc(Tables(spark, sf_dir)))
    orders = routed.where(F.col("topic") == ingest.TOPIC_ORDER_INFO).select("seq", "value")
    return ingest.decode_orders(orders)


@register("json_decode_lines", with_views("v_cdc_routed") + """
    select seq, json_extract_string(value, '$.id') as id, json_extract_string(value, '$.order_id') as order_id,
           json_extract_string(value, '$.sku_name') as sku_name, json_extract_string(value, '$.sku_id') as sku_id,
           try_cast(json_extract_string(value, '$.order_price') as double) as order_price,
           json_extract_string(value, '$.img_url') as img_url,
           try_cast(json_extract_string(value, '$.sku_num') as bigint) as sku_num
    from v_cdc_routed where topic = 'GMALL_ORDER_DETAIL'""")
def q_json_decode_lines(spark, sf_dir):
    routed = ingest.route_changes(fx.v_cdc(Tables(spark, sf_dir)))
    return ingest.decode_order_lines(routed.where(F.col("topic") == ingest.TOPIC_ORDER_DETAIL).select("seq", "value"))


@register("stream_cdc_feed", REGISTRY["cdc_route"].sql)
def q_stream_cdc_feed(spark, sf_dir):
    """The feed grows while its reader is stopped; the reader goes on from its offset."""
    changes = fx.v_cdc(Tables(spark, sf_dir))
    feed = f"{scratch_path(spark, 'change-feed')}/feed"
    run = stream_jobs.StreamRun.fresh(spark, "stream-cdc-feed")
    for part in range(2):
        change_feed.append_changes(changes.where(F.pmod(F.xxhash64("table", "seq"), F.lit(2)) == part), feed)
        stream_jobs.run_cdc_feed(spark, feed, run=run, trigger=_AVAILABLE_NOW)
    return stream_jobs.read_routed(spark, run).select("table", "seq", "topic", "value")


def _user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = ingest.route_changes(fx.v_cdc(Tables(spark, sf_dir)))
    users = ingest.decode_users(routed.where(F.col("topic") == ingest.TOPIC_USER_INFO).select("seq", "value"))
    return ingest.latest_per_key(users, ["id"], "seq").select("id", "login_name", "user_level", "birthday", "gender", "seq")


@register("user_dim_latest", with_views("v_user_latest") + "select * from v_user_latest")
def q_user_dim_latest(spark, sf_dir):
    return _user_dim(spark, sf_dir)


@register("upsert_compact", with_views("v_cdc_routed") + """
    , u as (select json_extract_string(value, '$.id') as id0, json_extract_string(value, '$.user_level') as user_level,
                   coalesce(json_extract_string(value, '$.gender'), 'none') as part, seq
            from v_cdc_routed where topic = 'GMALL_USER_INFO')
    select id0 as id, user_level, part, seq
    from (select *, row_number() over (partition by id0 order by seq desc) as rn from u
          where cast(id0 as bigint) % 11 <> 0)
    where rn = 1
    union all
    select distinct null, user_level, part, seq from u where cast(id0 as bigint) % 11 = 0""")
def q_upsert_compact(spark, sf_dir):
    """User changes, some without an id, written, replayed and compacted twice."""
    routed = ingest.route_changes(fx.v_cdc(Tables(spark, sf_dir)))
    users = ingest.decode_users(routed.where(F.col("topic") == ingest.TOPIC_USER_INFO).select("seq", "value"))
    rows = users.select(
        F.when(F.col("id").cast("long") % 11 != 0, F.col("id")).alias("id"), "user_level", "seq",
        F.coalesce("gender", F.lit("none")).alias("part"))
    path = f"{scratch_path(spark, 'upsert-compact')}/table"
    for _ in range(2):
        append_versions(rows, path, "part")
    for _ in range(2):
        compact(spark, path, ["id"], "seq", "part")
    return read_latest(spark, path, ["id"], "seq", "max").select("id", "user_level", "part", "seq")


@register("raw_log_archive", with_views("v_log_routed") + """
    select strftime(make_timestamp(received_ms * 1000), '%Y-%m-%d') as day, value from v_log_routed""")
def q_raw_log_archive(spark, sf_dir):
    routed = ingest.route_logs(fx.v_raw_log(Tables(spark, sf_dir)))
    path = scratch_path(spark, "raw-log-archive")
    file_sinks.archive_lines(routed, path)
    return file_sinks.read_archive(spark, path).select("day", "value")


# --- dashboard answers -------------------------------------------------------------

@register("realtime_total", with_views("v_dau", "v_order_enriched") + f"""
    select 'dau' as id, '{serving.CARD_DAU[1]}' as name,
           cast((select count(*) from v_dau where logdate = '{DAU_DATE}') as double) as value
    union all
    select 'new_mid', '{serving.CARD_NEW_MID[1]}',
           cast((select count(*) from (select mid, min(logdate) as d from v_dau group by mid)
                 where d = '{DAU_DATE}') as double)
    union all
    select 'order_amount', '{serving.CARD_ORDER_AMOUNT[1]}',
           round((select sum(total_amount) from v_order_enriched where create_date = '{GMV_DATE}'), 2)""")
def q_realtime_total(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lo, hi = day_bounds_ts(DAU_DATE)
    dau_day = dau_ops.first_start_per_day(fx.v_startup(t, lo, hi))
    history = dau_ops.first_start_per_day(fx.v_startup(t, None, hi))
    orders = gmv_ops.enrich_orders(fx.v_order(t, GMV_DATE, day_after(GMV_DATE)))
    return serving.metric_cards(
        dau_ops.dau_total(dau_day, DAU_DATE),
        dau_ops.new_devices_on(history, DAU_DATE),
        gmv_ops.gmv_total(orders, GMV_DATE).select(F.round("sum_amount", 2)),
    )


_HOURS_SQL = "(select lpad(cast(h as varchar), 2, '0') as hour from range(24) t(h))"


@register("realtime_hours_dau", with_views("v_dau") + f"""
    select x.hour, coalesce(a.today, 0) as today, coalesce(a.yesterday, 0) as yesterday
    from {_HOURS_SQL} x left join
         (select loghour as hour, count(*) filter (where logdate = '{DAU_DATE}') as today,
                 count(*) filter (where logdate = '{day_before(DAU_DATE)}') as yesterday
          from v_dau where logdate in ('{DAU_DATE}', '{day_before(DAU_DATE)}') group by loghour) a
    on x.hour = a.hour""")
def q_realtime_hours_dau(spark, sf_dir):
    return _hours_dau(spark, sf_dir)


def _hours_dau(spark: SparkSession, sf_dir: str, fill=0) -> DataFrame:
    lo, hi = day_bounds_ts(day_before(DAU_DATE), 2)
    dau = dau_ops.first_start_per_day(fx.v_startup(Tables(spark, sf_dir), lo, hi))
    per_hour = dau.groupBy("logdate", "loghour").agg(F.count(F.lit(1)).alias("ct"))
    return serving.today_vs_yesterday(spark, per_hour, DAU_DATE, "logdate", "loghour", "ct", fill)


@register("realtime_hours_amount", with_views("v_order_enriched") + f"""
    select x.hour, round(coalesce(a.today, 0), 2) as today, round(coalesce(a.yesterday, 0), 2) as yesterday
    from {_HOURS_SQL} x left join
         (select create_hour as hour,
                 sum(total_amount) filter (where create_date = '{GMV_DATE}') as today,
                 sum(total_amount) filter (where create_date = '{day_before(GMV_DATE)}') as yesterday
          from v_order_enriched where create_date in ('{GMV_DATE}', '{day_before(GMV_DATE)}')
          group by create_hour) a
    on x.hour = a.hour""")
def q_realtime_hours_amount(spark, sf_dir):
    out = _hours_amount(spark, sf_dir)
    return out.select("hour", F.round("today", 2).alias("today"), F.round("yesterday", 2).alias("yesterday"))


def _hours_amount(spark: SparkSession, sf_dir: str, fill=0) -> DataFrame:
    t = Tables(spark, sf_dir)
    orders = gmv_ops.enrich_orders(fx.v_order(t, day_before(GMV_DATE), day_after(GMV_DATE)))
    per_hour = orders.groupBy("create_date", "create_hour").agg(F.sum("total_amount").alias("amount"))
    return serving.today_vs_yesterday(spark, per_hour, GMV_DATE, "create_date", "create_hour", "amount", fill)


@register("realtime_hours_json", with_views("v_dau") + f"""
    select '{{"yesterday":' || coalesce((select '{{' || string_agg('"' || loghour || '":' || cast(ct as varchar), ','
                                                               order by loghour) || '}}'
                                         from (select loghour, count(*) as ct from v_dau
                                               where logdate = '{day_before(DAU_DATE)}' group by loghour)), '{{}}')
           || ',"today":' || coalesce((select '{{' || string_agg('"' || loghour || '":' || cast(ct as varchar), ','
                                                             order by loghour) || '}}'
                                       from (select loghour, count(*) as ct from v_dau
                                             where logdate = '{DAU_DATE}' group by loghour)), '{{}}')
           || '}}' as json""")
def q_realtime_hours_json(spark, sf_dir):
    return serving.hour_maps_json(_hours_dau(spark, sf_dir, fill=None))


def _amount_map_sql(date: str) -> str:
    return f"""coalesce((select '{{' || string_agg('"' || create_hour || '":' || cast(amount as varchar), ','
                                                order by create_hour) || '}}'
                         from (select create_hour, cast(round(sum(total_amount), 2) as decimal(18, 2)) as amount
                               from v_order_enriched where create_date = '{date}' group by create_hour)), '{{}}')"""


@register("realtime_hours_amount_json", with_views("v_order_enriched") + f"""
    select '{{"yesterday":' || {_amount_map_sql(day_before(GMV_DATE))}
           || ',"today":' || {_amount_map_sql(GMV_DATE)} || '}}' as json""")
def q_realtime_hours_amount_json(spark, sf_dir):
    return serving.hour_maps_json(_hours_amount(spark, sf_dir, fill=None).select(
        "hour", *[F.round(c, 2).cast("decimal(18,2)").alias(c) for c in ("today", "yesterday")]))


# --- coupon alerts -------------------------------------------------------------------

_WINDOW_MS = 6 * 3600 * 1000
_SLIDE_MS = 3600 * 1000
_ALERTS_SQL = with_views("v_event") + f"""
    , w as (select mid, uid, evid, itemid, (ts // {_SLIDE_MS}) * {_SLIDE_MS} - k * {_SLIDE_MS} as wstart
            from v_event cross join range(0, {_WINDOW_MS // _SLIDE_MS}) r(k))
    , g as (select wstart, mid,
                   count(distinct uid) filter (where evid = 'coupon') as n_uids,
                   string_agg(distinct uid, ',' order by uid) filter (where evid = 'coupon') as uids,
                   string_agg(distinct itemid, ',' order by itemid) filter (where evid = 'coupon') as item_ids,
                   coalesce(bool_or(evid = 'clickItem'), false) as clicked
            from w group by wstart, mid)
    , e as (select wstart, mid, string_agg(evid || ':' || cast(n as varchar), ','
                                           order by evid || ':' || cast(n as varchar)) as events
            from (select wstart, mid, evid, count(*) as n from w group by wstart, mid, evid)
            group by wstart, mid)
    , alerts as (
        select g.mid, strftime(make_timestamp(g.wstart * 1000), '%Y-%m-%d %H:%M:%S') as window_start,
               strftime(make_timestamp((g.wstart + {_WINDOW_MS}) * 1000), '%Y-%m-%d %H:%M:%S') as window_end,
               g.uids, g.item_ids, e.events, g.wstart + {_WINDOW_MS} as ts
        from g join e on g.wstart = e.wstart and g.mid = e.mid
        where g.n_uids >= {alert_ops.MIN_ACCOUNTS} and not g.clicked)
"""


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.v_event(Tables(spark, sf_dir)).select("mid", "uid", "evid", "itemid", "ts")
    return alert_ops.coupon_alerts(events, ALERT_WINDOW, ALERT_SLIDE)


@register("coupon_alerts", _ALERTS_SQL + "select * from alerts")
def q_coupon_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir)


@register("coupon_alerts_latest", _ALERTS_SQL + """
    select day, doc_id, mid, window_start, window_end, uids, item_ids, events, ts
    from (select *, row_number() over (partition by day, doc_id order by ts desc) as rn
          from (select *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') as day,
                       mid || '-' || strftime(make_timestamp(ts * 1000), '%H:%M') as doc_id
                from alerts))
    where rn = 1""")
def q_coupon_alerts_latest(spark, sf_dir):
    return alert_ops.latest_alert_per_doc(_alerts(spark, sf_dir))


# --- sale detail ----------------------------------------------------------------------

_SALE_VERSION = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
_SALE_OUT = ("doc_id",) + sale_ops.SALE_COLUMNS


def _order_and_details(spark: SparkSession, sf_dir: str, dt: str | None = None, t: Tables | None = None):
    """Orders (optionally of one order day, pruned at the scan) and their lines."""
    t = t or Tables(spark, sf_dir)
    if dt is None:
        orders = fx.v_order(t)
    else:
        # The orders of one day are usually few: when a count proves it,
        # they are broadcast and the lines are joined to them where they are
        # read, so the line table is never shuffled for a one-day query.
        orders = broadcast_if_few(fx.v_order(t, dt, day_after(dt)).where(F.col("create_date") == dt))
    return orders, fx.v_detail(t, orders)


def _sale_table(spark: SparkSession, sf_dir: str, dt: str | None = None) -> DataFrame:
    """The upserted sale-detail table: every line with its order, enriched,
    one row per document id (newest version).

    With ``dt`` only that order day is built: every version of a document
    belongs to the same order, hence to the same day, so restricting the
    orders before the dedup gives the same rows as filtering the table after
    it (the role of the day-partitioned index).
    """
    t = Tables(spark, sf_dir)
    orders, details = _order_and_details(spark, sf_dir, dt, t)
    # An order meets its user once, before its lines do.
    placed = sale_ops.with_user_fields(orders, fx.v_user(t), AGE_ASOF)
    enriched = sale_ops.inner_join(placed, details, extra=_SALE_VERSION, order_extra=sale_ops.USER_COLUMNS)
    latest = sale_ops.latest_per_doc(enriched, _SALE_VERSION + ("sku_price",))
    return latest.select(*_SALE_OUT)


def _written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table that is built once and read with pruned columns; encoded and
    compressed it takes a part of what checkpointed rows take."""
    path = f"{scratch_path(rows.sparkSession, name)}/table"
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _sale_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, sku_name)`` of the upserted sale-detail table: the text that
    relevance statistics are taken from.

    Same documents and names as :func:`_sale_table` without the user join
    (a left join keeps every row) and without the other columns, so only the
    ids, the name and the version cross the dedup shuffle.  Ties on the whole
    version share ``l_partkey``, hence the name.
    """
    orders, details = _order_and_details(spark, sf_dir)
    wide = sale_ops.inner_join(orders, details, extra=_SALE_VERSION)
    version = _SALE_VERSION + ("sku_price",)
    lean = wide.select("order_id", "order_detail_id", "sku_name", *version)
    return sale_ops.latest_per_doc(lean, version).select("doc_id", "sku_name")


@register("order_detail_interval_join", with_views("v_sale_interval") + "select * from v_sale_interval")
def q_order_detail_interval_join(spark, sf_dir):
    orders, details = _order_and_details(spark, sf_dir)
    return sale_ops.interval_join(orders, details)


@register("order_detail_full_outer", with_views("v_order", "v_detail") + """
    select coalesce(o.id, d.order_id) as order_id, d.id as order_detail_id, o.order_status, o.create_time,
           o.user_id, d.sku_id, cast(d.order_price as double) as sku_price, o.create_date as dt
    from v_order o full outer join v_detail d on o.id = d.order_id""")
def q_order_detail_full_outer(spark, sf_dir):
    orders, details = _order_and_details(spark, sf_dir)
    return sale_ops.full_outer_join(orders, details)


@register("sale_detail_enriched", with_views("v_sale_interval", "v_user") + f"""
    select s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
           u.gender as user_gender,
           coalesce(cast(date_diff('day', u.birthday, date '{AGE_ASOF}') // 365 as integer), 0) as user_age,
           u.user_level, s.sku_price, s.sku_name, s.dt
    from v_sale_interval s left join v_user u on s.user_id = u.id""")
def q_sale_detail_enriched(spark, sf_dir):
    orders, details = _order_and_details(spark, sf_dir)
    joined = sale_ops.interval_join(orders, details)
    return sale_ops.enrich_with_users(joined, fx.v_user(Tables(spark, sf_dir)), AGE_ASOF)


@register("sale_detail_upsert", with_views("v_sale_table") + "select * from v_sale_table")
def q_sale_detail_upsert(spark, sf_dir):
    return _sale_table(spark, sf_dir)


# --- search over the sale-detail table ----------------------------------------------------

def _kw_list(keyword: str) -> str:
    return "[" + ", ".join(f"'{t}'" for t in search_ops._keyword_tokens(keyword)) + "]"


def _hits_sql(dt: str | None, keyword: str) -> str:
    date_pred = f"dt = '{dt}' and " if dt else ""
    return f"(select * from v_sale_tokens where {date_pred}list_has_all(toks, {_kw_list(keyword)}))"


def _bm25_sql(dt: str | None, keyword: str) -> str:
    k1, b = search_ops.BM25_K1, search_ops.BM25_B
    return f"""
    , stats as (select count(*) as n, avg(dl) as avgdl from v_sale_tokens)
    , dfs as (select term, count(*) as df from (select unnest(toks) as term from v_sale_tokens)
              where list_contains({_kw_list(keyword)}, term) group by term)
    , q as (select unnest({_kw_list(keyword)}) as term)
    , hits as {_hits_sql(dt, keyword)}
    , scored as (
        select h.doc_id, sum(ln(1 + (s.n - coalesce(d.df, 0) + 0.5) / (coalesce(d.df, 0) + 0.5))
                             * tf * {k1 + 1.0} / (tf + {k1} * ({1.0 - b} + {b} * h.dl / s.avgdl))) as score
        from (select h.*, q.term,
                     len(list_filter(regexp_split_to_array(lower(h.sku_name), '[^\\p{{L}}\\p{{N}}]+'),
                                     lambda x: x = q.term)) as tf
              from hits h cross join q) h
        cross join stats s left join dfs d on d.term = h.term
        group by h.doc_id)
"""


def _search_hits(spark: SparkSession, sf_dir: str, dt: str | None, keyword: str) -> DataFrame:
    """The hits of the query: the day filter is applied where the orders are
    read, the keyword after the dedup (an older version of a line may name
    another product).  Only relevance needs the whole table (the corpus)."""
    day = _sale_table(spark, sf_dir, dt)
    return day.where(search_ops.all_tokens_match("sku_name", keyword))


@register("search_total", with_views("v_sale_tokens") + f"""
    select count(*) as total from {_hits_sql(SEARCH_DT, SEARCH_KEYWORD)}""")
def q_search_total(spark, sf_dir):
    found = _search_hits(spark, sf_dir, SEARCH_DT, SEARCH_KEYWORD)
    return search_ops.total(found)


@register("facet_age", with_views("v_sale_tokens") + f"""
    select user_age, count(*) as cnt from {_hits_sql(SEARCH_DT, SEARCH_KEYWORD)}
    group by user_age order by cnt desc, user_age limit {search_ops.AGE_FACET_SIZE}""")
def q_facet_age(spark, sf_dir):
    found = _search_hits(spark, sf_dir, SEARCH_DT, SEARCH_KEYWORD)
    return search_ops.facet_age(found)


@register("facet_gender", with_views("v_sale_tokens") + f"""
    select user_gender, count(*) as cnt from {_hits_sql(SEARCH_DT, SEARCH_KEYWORD)}
    where user_gender is not null
    group by user_gender order by cnt desc, user_gender limit {search_ops.GENDER_FACET_SIZE}""")
def q_facet_gender(spark, sf_dir):
    found = _search_hits(spark, sf_dir, SEARCH_DT, SEARCH_KEYWORD)
    return search_ops.facet_gender(found)


_SHARES_SQL = f"""
    , fa as (select user_age, count(*) as cnt from hits group by user_age
             order by cnt desc, user_age limit {search_ops.AGE_FACET_SIZE})
    , fg as (select user_gender, count(*) as cnt from hits where user_gender is not null
             group by user_gender order by cnt desc, user_gender limit {search_ops.GENDER_FACET_SIZE})
    , r as (select total,
                   ((select coalesce(sum(cnt), 0) from fa where user_age < 20) * 1000 // total) / 10.0 as a,
                   ((select coalesce(sum(cnt), 0) from fa where user_age >= 20 and user_age < 30) * 1000 // total) / 10.0 as b,
                   ((select coalesce(sum(cnt), 0) from fg where user_gender = 'F') * 1000 // total) / 10.0 as f
            from (select count(*) as total from hits) where total > 0)
    , shares as (select 1 as pos, '{search_ops.m.AGE_TITLE}' as title, '{search_ops.m.AGE_UNDER_20}' as name, a as value from r
    union all select 2, '{search_ops.m.AGE_TITLE}', '{search_ops.m.AGE_20_TO_29}', b from r
    union all select 3, '{search_ops.m.AGE_TITLE}', '{search_ops.m.AGE_30_PLUS}', 100.0 - a - b from r
    union all select 4, '{search_ops.m.GENDER_TITLE}', '{search_ops.m.MALE}', 100.0 - f from r
    union all select 5, '{search_ops.m.GENDER_TITLE}', '{search_ops.m.FEMALE}', f from r)"""


@register("age_gender_ratio", with_views("v_sale_tokens") + f"""
    , hits as {_hits_sql(SEARCH_DT, SEARCH_KEYWORD)}""" + _SHARES_SQL + "select * from shares")
def q_age_gender_ratio(spark, sf_dir):
    found = _search_hits(spark, sf_dir, SEARCH_DT, SEARCH_KEYWORD)
    return search_ops.age_gender_shares(found)


@register("sale_search_bm25", with_views("v_sale_tokens") + _bm25_sql(None, BM25_KEYWORD) + """
    select doc_id, round(score, 6) as score from scored""")
def q_sale_search_bm25(spark, sf_dir):
    # Corpus statistics and hits come from the same documents: build the
    # two-column corpus once, written to the checkpoint folder, and read it twice.
    table = _written(_sale_corpus(spark, sf_dir), "sale-corpus")
    found = table.where(search_ops.all_tokens_match("sku_name", BM25_KEYWORD))
    scored = search_ops.bm25_scores(table, found, BM25_KEYWORD)
    return scored.select("doc_id", F.round("score", 6).alias("score"))


@register("sale_search_page", with_views("v_sale_tokens") + _bm25_sql(SEARCH_DT, SEARCH_KEYWORD) + f"""
    select t.doc_id, t.order_detail_id, t.order_id, t.order_status, t.create_time, t.user_id, t.sku_id,
           t.user_gender, t.user_age, t.user_level, t.sku_price, t.sku_name, t.dt, round(s.score, 6) as score
    from scored s join v_sale_tokens t on s.doc_id = t.doc_id
    order by s.score desc, s.doc_id
    limit {SEARCH_PAGE_SIZE} offset {(SEARCH_PAGE - 1) * SEARCH_PAGE_SIZE}""")
def q_sale_search_page(spark, sf_dir):
    found = _search_hits(spark, sf_dir, SEARCH_DT, SEARCH_KEYWORD)
    scored = search_ops.bm25_scores(_sale_corpus(spark, sf_dir), found, SEARCH_KEYWORD)
    page = search_ops.ranked_page(scored, SEARCH_PAGE, SEARCH_PAGE_SIZE)
    return page.withColumn("score", F.round("score", 6))


@register("sale_search_postings", REGISTRY["sale_search_bm25"].sql)
def q_sale_search_postings(spark, sf_dir):
    """The relevance of all documents from an inverted index.  Sale rows come to the
    index in two batches, so the second one replaces documents of the first."""
    orders, details = _order_and_details(spark, sf_dir)
    version = _SALE_VERSION + ("sku_price",)
    lean = sale_ops.inner_join(orders, details, extra=_SALE_VERSION).select("order_id", "order_detail_id", "sku_name", *version)
    path = scratch_path(spark, "postings")
    for batch_id in range(2):
        batch = sale_ops.latest_per_doc(lean.where(F.col("l_partkey") % 2 == batch_id), version)
        postings.append_documents(
            batch.select("doc_id", F.col("sku_name").alias("text"), F.struct(*version).alias("version")), path, batch_id)
    found = postings.search(spark, path, search_ops._keyword_tokens(BM25_KEYWORD), search_ops.BM25_K1, search_ops.BM25_B)
    return found.select("doc_id", F.round("score", 6).alias("score"))


HAN_KEYWORD = "红色戒"


@register("sku_search_pairs", with_views("v_product_han") + f"""
    , runs as (select sku_id, unnest(regexp_extract_all(sku_name, '\\p{{Han}}+|[a-z0-9]+')) as r from v_product_han)
    , toks as (
        select sku_id, r as term from runs where not regexp_matches(r, '\\p{{Han}}')
        union all select sku_id, unnest(list_transform(range(1, length(r) + 1), lambda i: substr(r, i, 1)))
        from runs where regexp_matches(r, '\\p{{Han}}')
        union all select sku_id, unnest(list_transform(range(1, length(r)), lambda i: substr(r, i, 2)))
        from runs where regexp_matches(r, '\\p{{Han}}'))
    , lengths as (select sku_id, count(*) as dl from toks group by sku_id)
    , whole as (select count(*) as n, avg(dl) as mean from lengths)
    , q as (select unnest(list_transform(range(1, length('{HAN_KEYWORD}')), lambda i: substr('{HAN_KEYWORD}', i, 2))) as term)
    , tfs as (select sku_id, term, count(*) as tf from toks where term in (select term from q) group by sku_id, term)
    , dfs as (select term, count(*) as df from tfs group by term)
    select sku_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {search_ops.BM25_K1 + 1.0}
               / (tf + {search_ops.BM25_K1} * ({1.0 - search_ops.BM25_B} + {search_ops.BM25_B} * dl / mean))), 6) as score
    from tfs join dfs using (term) join lengths using (sku_id), whole
    group by sku_id having count(*) = (select count(*) from q)""")
def q_sku_search_pairs(spark, sf_dir):
    """Products by a keyword in a script without spaces, from an inverted index of characters and pairs."""
    names = fx.v_product_han(Tables(spark, sf_dir))
    path = scratch_path(spark, "pair-postings")
    postings.append_documents(names.select(F.col("sku_id").alias("doc_id"), F.col("sku_name").alias("text"), F.lit(0).alias("version")),
                              path, 0, analyze=script_tokens)
    # The keyword's tokens by the same functions as the texts': one row.
    terms = spark.range(1).select(script_keyword_tokens(F.lit(HAN_KEYWORD))).first()[0]
    found = postings.search(spark, path, terms, search_ops.BM25_K1, search_ops.BM25_B)
    return found.select(F.col("doc_id").alias("sku_id"), F.round("score", 6).alias("score"))


@register("search_answer", with_views("v_sale_tokens") + _bm25_sql(SEARCH_DT, SEARCH_KEYWORD) + f"""
    select 'total' as part, 1 as pos, null as name, cast(count(*) as double) as value from hits
    union all
    select 'age', row_number() over (order by cnt desc, user_age), cast(user_age as varchar), cnt
    from (select user_age, count(*) as cnt from hits group by user_age order by cnt desc, user_age limit {search_ops.AGE_FACET_SIZE})
    union all
    select 'gender', row_number() over (order by cnt desc, user_gender), user_gender, cnt
    from (select user_gender, count(*) as cnt from hits where user_gender is not null group by user_gender
          order by cnt desc, user_gender limit {search_ops.GENDER_FACET_SIZE})
    union all
    select 'hit', row_number() over (order by score desc, doc_id) + {(SEARCH_PAGE - 1) * SEARCH_PAGE_SIZE}, doc_id, round(score, 6)
    from (select doc_id, score from scored order by score desc, doc_id
          limit {SEARCH_PAGE_SIZE} offset {(SEARCH_PAGE - 1) * SEARCH_PAGE_SIZE})""")
def q_search_answer(spark, sf_dir):
    # The sale table is built and written once; statistics and hits are read from it.
    table = _written(_sale_table(spark, sf_dir).select("doc_id", "sku_name", "dt", "user_age", "user_gender"), "sale-table")
    found = table.where((F.col("dt") == SEARCH_DT) & search_ops.all_tokens_match("sku_name", SEARCH_KEYWORD))
    scored = search_ops.bm25_scores(table, found, SEARCH_KEYWORD).select("doc_id", "user_age", "user_gender", "score")
    checkpoint_root(spark)
    return search_ops.answer_parts(scored.checkpoint(eager=True), SEARCH_PAGE, SEARCH_PAGE_SIZE)


@register("sale_detail_json", with_views("v_sale_tokens") + _bm25_sql(SEARCH_DT, SEARCH_KEYWORD) + _SHARES_SQL + f"""
    , opts as (select title, min(pos) as pos, list({{'name': name, 'value': value}} order by pos) as options
               from shares group by title)
    , page as (select t.doc_id, t.order_detail_id, t.order_id, t.order_status, t.create_time, t.user_id, t.sku_id,
                      t.user_gender, t.user_age, t.user_level, t.sku_price, t.sku_name, t.dt,
                      round(s.score, {search_ops.SCORE_DIGITS}) as score, s.score as place
               from scored s join v_sale_tokens t on s.doc_id = t.doc_id
               order by s.score desc, s.doc_id
               limit {SEARCH_PAGE_SIZE} offset {(SEARCH_PAGE - 1) * SEARCH_PAGE_SIZE})
    , detail as (select list(json_merge_patch('{{}}', to_json({{
                     {", ".join(f"'{c}': {c}" for c in (*_SALE_OUT, "score"))}}})) order by place desc, doc_id) as rows
                 from page)
    select case when (select count(*) from hits) = 0 then '{{}}'
           else cast(to_json({{'total': (select count(*) from hits),
                               'stat': (select list({{'title': title, 'options': options}} order by pos) from opts),
                               'detail': (select coalesce(rows, []) from detail)}}) as varchar) end as json""")
def q_sale_detail_json(spark, sf_dir):
    # The day's hits are read for the total, the shares and the page: written once.
    checkpoint_root(spark)
    found = _search_hits(spark, sf_dir, SEARCH_DT, SEARCH_KEYWORD).checkpoint(eager=True)
    scored = search_ops.bm25_scores(_sale_corpus(spark, sf_dir), found, SEARCH_KEYWORD)
    page = search_ops.ranked_page(scored, SEARCH_PAGE, SEARCH_PAGE_SIZE)
    return search_ops.sale_detail_answer(search_ops.age_gender_shares(found), page, found)


# --- join demo ---------------------------------------------------------------------------

_DOD_SQL = with_views("v_dau") + """
    select coalesce(l.mid, r.mid) as mid, coalesce(l.logdate, r.next_day) as day,
           l.uid as today_uid, r.uid as yesterday_uid
    from v_dau l {how} join
         (select mid, strftime(cast(logdate as date) + 1, '%Y-%m-%d') as next_day, uid from v_dau) r
      on l.mid = r.mid and l.logdate = r.next_day"""


def _register_join(kind: str, sql_kind: str) -> None:
    @register(f"join_{kind}", _DOD_SQL.format(how=sql_kind))
    def run(spark, sf_dir):
        return join_ops.day_over_day(_dau_table(spark, sf_dir), kind)


for _kind, _sql_kind in (("inner", "inner"), ("left", "left"), ("right", "right"), ("full", "full outer")):
    _register_join(_kind, _sql_kind)


# --- streaming twins (same answers as the batch keys) ----------------------------------------
#
# Each key runs its streaming job over the driver's files with an
# ``availableNow`` trigger (the backlog in micro-batches, then stop), with a
# fresh checkpoint under the session's checkpoint root, and returns the table
# the job wrote.

_AVAILABLE_NOW = {"availableNow": True}


@register("stream_dau_dedup", REGISTRY["startup_first_per_day"].sql)
def q_stream_dau_dedup(spark, sf_dir):
    _, run = stream_jobs.run_dau(spark, sf_dir, trigger=_AVAILABLE_NOW)
    cols = q_startup_first_per_day(spark, sf_dir).columns
    return stream_jobs.read_dau(spark, run).select(*cols)


@register("stream_stage_counts", with_views("v_log", "v_startup", "v_dau") + """
    select 'logs' as stage, count(*) as rows from v_log union all select 'starts', count(*) from v_startup
    union all select 'firsts', count(*) from v_dau""")
def q_stream_stage_counts(spark, sf_dir):
    path = f"{scratch_path(spark, 'stage-counts')}/table"
    _, _, counts = stage_counts.run_counted_dau(spark, sf_dir, path, trigger=_AVAILABLE_NOW)
    return counts.read().groupBy("stage").agg(F.sum("rows").alias("rows"))


@register("stream_dau_seen_set", REGISTRY["startup_first_per_day"].sql)
def q_stream_dau_seen_set(spark, sf_dir):
    _, run = stream_jobs.run_dau_seen_set(spark, sf_dir, trigger=_AVAILABLE_NOW)
    cols = q_startup_first_per_day(spark, sf_dir).columns
    return stream_jobs.read_dau_seen_set(spark, run).select(*cols)


@register("stream_dau_by_hour", REGISTRY["dau_by_hour"].sql)
def q_stream_dau_by_hour(spark, sf_dir):
    _, run = stream_jobs.run_dau(spark, sf_dir, trigger=_AVAILABLE_NOW)
    return dau_ops.dau_by_hour(stream_jobs.read_dau(spark, run), DAU_DATE)


@register("stream_gmv_by_hour", REGISTRY["gmv_by_hour"].sql)
def q_stream_gmv_by_hour(spark, sf_dir):
    _, run = stream_jobs.run_gmv(spark, sf_dir, trigger=_AVAILABLE_NOW)
    out = gmv_ops.gmv_by_hour(stream_jobs.read_orders(spark, run, GMV_DATE), GMV_DATE)
    return out.select("create_hour", F.round("sum_amount", 2).alias("sum_amount"))


@register("stream_order_compact", REGISTRY["order_enriched"].sql)
def q_stream_order_compact(spark, sf_dir):
    """Some orders come with another amount first; the first batch is compacted before the
    stream goes on, everything afterwards."""
    orders = Tables(spark, sf_dir).orders
    first = orders.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    run = stream_jobs.StreamRun.fresh(spark, "stream-orders")
    table = stream_jobs.order_table(run)
    for number, folder in enumerate(_in_slices(spark, "orders", [first, orders])):
        stream_jobs.run_order_table(spark, sf_dir, run=run, trigger=_AVAILABLE_NOW, stream_dir=folder)
        table.compact(spark, number)
    table.drop_covered(spark)
    return table.read(spark).select(*gmv_ops.ORDER_COLUMNS)


@register("stream_coupon_alerts", REGISTRY["coupon_alerts"].sql)
def q_stream_coupon_alerts(spark, sf_dir):
    _, run = stream_jobs.run_alert_counts(spark, sf_dir, ALERT_WINDOW, ALERT_SLIDE, trigger=_AVAILABLE_NOW)
    return stream_jobs.read_alerts(spark, run)


@register("stream_coupon_alerts_latest", REGISTRY["coupon_alerts_latest"].sql)
def q_stream_coupon_alerts_latest(spark, sf_dir):
    _, run = stream_jobs.run_alert_counts(spark, sf_dir, ALERT_WINDOW, ALERT_SLIDE, trigger=_AVAILABLE_NOW)
    cols = q_coupon_alerts_latest(spark, sf_dir).columns
    return stream_jobs.read_latest_alerts(spark, run).select(*cols)


@register("stream_order_join", REGISTRY["order_detail_interval_join"].sql)
def q_stream_order_join(spark, sf_dir):
    _, run = stream_jobs.run_order_join(spark, sf_dir, trigger=_AVAILABLE_NOW)
    cols = q_order_detail_interval_join(spark, sf_dir).columns
    return stream_jobs.read_order_join(spark, run).select(*cols)


@register("stream_upsert", with_views("v_sale_stream_table") + "select * from v_sale_stream_table")
def q_stream_upsert(spark, sf_dir):
    _, run = stream_jobs.run_sale_upsert(spark, sf_dir, AGE_ASOF, trigger=_AVAILABLE_NOW)
    return stream_jobs.read_sale_table(spark, run)


@register("stream_ttl_join", with_views("v_sale_ttl") + "select * from v_sale_ttl")
def q_stream_ttl_join(spark, sf_dir):
    feed = f"{scratch_path(spark, 'arrivals')}/feed"
    feeds.write_feed(feeds.order_arrivals(Tables(spark, sf_dir)), feed)
    _, run = caches.run_ttl_join(spark, feed, trigger=_AVAILABLE_NOW)
    return caches.read_pairs(spark, run)


# Orders and lines that reach the feed after its end in the outer join query.
LATE_ORDER_EVERY, LATE_LINE_EVERY = 97, 50


@register("stream_outer_join", with_views("v_order", "v_detail") + f"""
    , o as (select *, o_orderkey % {LATE_ORDER_EVERY} = 0 as late from v_order)
    , d as (select *, (cast(order_id as bigint) * 31 + l_linenumber) % {LATE_LINE_EVERY} = 0 as late from v_detail)
    select case when o.id is null then 'line' when d.id is null then 'order' else 'matched' end as status,
           coalesce(o.id, d.order_id) as order_id, d.id as order_detail_id, o.order_status, o.create_time, o.user_id,
           o.create_date as dt, d.sku_id, d.sku_name, cast(d.order_price as double) as sku_price
    from (select * from o where not late) o full outer join (select * from d where not late) d
      on o.id = d.order_id and d.arrival_ts between o.create_ts - interval 120 second and o.create_ts + interval 120 second
    union all select 'late_order', id, null, order_status, create_time, user_id, create_date, null, null, null from o where late
    union all select 'late_line', order_id, id, null, null, null, null, sku_id, sku_name, cast(order_price as double)
    from d where late""")
def q_stream_outer_join(spark, sf_dir):
    """Some rows come after the feed's end, to a query that is stopped and resumed."""
    arrivals = feeds.order_arrivals(Tables(spark, sf_dir), rewrites=False)
    line = F.split("d.order_detail_id", "-")
    late = F.coalesce(
        (line[0].cast("long") * 31 + line[1].cast("long")) % LATE_LINE_EVERY == 0,
        F.col("order_id").cast("long") % LATE_ORDER_EVERY == 0)
    feed = f"{scratch_path(spark, 'arrivals')}/feed"
    feeds.write_feed(arrivals.where(~late), feed)
    _, run = outer_join.run_outer_join(spark, feed, trigger=_AVAILABLE_NOW)
    feeds.write_feed(arrivals.where(late), feed, close=False)
    _, run = outer_join.run_outer_join(spark, feed, run=run, trigger=_AVAILABLE_NOW)
    return outer_join.read_outer(spark, run)


@register("sale_detail_asof", with_views("v_sale_interval", "v_user_history") + f"""
    select s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id, u.gender as user_gender,
           coalesce(cast(date_diff('day', u.birthday, date '{AGE_ASOF}') // 365 as integer), 0) as user_age,
           u.user_level, s.sku_price, s.sku_name, s.dt
    from v_sale_interval s asof left join v_user_history u
      on s.user_id = u.id and cast(s.create_time as timestamp) >= u.valid_from""")
def q_sale_detail_asof(spark, sf_dir):
    """Sales with the user as known when the order was placed."""
    orders, details = _order_and_details(spark, sf_dir)
    joined = sale_ops.interval_join(orders, details)
    return sale_ops.enrich_with_user_versions(joined, fx.v_user_history(Tables(spark, sf_dir)), AGE_ASOF)


def _in_slices(spark: SparkSession, table: str, rows: list[DataFrame]) -> Iterator[str]:
    """A folder that gets the table's rows one slice after another: it is given after each write, and a
    stream that then takes what is there, in one batch, takes that slice.  A slice has as many files as its rows
    have partitions, so neither writing nor reading it is left to one task."""
    folder = scratch_path(spark, f"{table}-slices")
    for part in rows:
        part.write.mode("append").parquet(f"{folder}/{table}")
        yield folder


# Slices by id, not by time, so that earlier starts come after later ones.
DASHBOARD_SLICES = 3


@register("stream_dau_dashboard", with_views("v_dau") + """
    select logdate, loghour, count(*) as ct from v_dau group by logdate, loghour""")
def q_stream_dau_dashboard(spark, sf_dir):
    events = Tables(spark, sf_dir).events
    slices = [events.where(F.col("event_id") % DASHBOARD_SLICES == i) for i in range(DASHBOARD_SLICES)]
    run = stream_jobs.StreamRun.fresh(spark, "stream-dau-dashboard")
    for folder in _in_slices(spark, "events", slices):
        dashboard.run_dau_dashboard(spark, sf_dir, run=run, trigger=_AVAILABLE_NOW, stream_dir=folder, lateness="3650 days")
    return dashboard.read_dau_dashboard(spark, run)


@register("stream_new_devices", REGISTRY["new_devices_by_day"].sql)
def q_stream_new_devices(spark, sf_dir):
    events = Tables(spark, sf_dir).events
    slices = [events.where(F.col("event_id") % DASHBOARD_SLICES == i) for i in range(DASHBOARD_SLICES)]
    run = stream_jobs.StreamRun.fresh(spark, "stream-new-devices")
    for folder in _in_slices(spark, "events", slices):
        dashboard.run_new_devices(spark, sf_dir, run=run, trigger=_AVAILABLE_NOW, stream_dir=folder)
    return dashboard.read_new_devices(spark, run)


@register("stream_gmv_dashboard", with_views("v_order_enriched") + """
    select create_date, create_hour, count(*) as orders, round(sum(total_amount), 2) as sum_amount
    from v_order_enriched group by create_date, create_hour""")
def q_stream_gmv_dashboard(spark, sf_dir):
    """Some orders come with another amount first."""
    orders = Tables(spark, sf_dir).orders
    first = orders.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    run = stream_jobs.StreamRun.fresh(spark, "stream-gmv-dashboard")
    for folder in _in_slices(spark, "orders", [first, orders]):
        dashboard.run_gmv_dashboard(spark, sf_dir, run=run, trigger=_AVAILABLE_NOW, stream_dir=folder)
    return dashboard.read_gmv_dashboard(spark, run)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.run for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}


__all__ = ["REGISTRY", "queries", "oracle_sql", "day_before"]
