"""DuckDB text of the fixture views, used by the oracle SQL of every key.

Each oracle query is ``WITH <views it needs> <select>``; the views mirror
:mod:`tidewater.sources.fixtures` in DuckDB's dialect (see FIXTURES.md §4).
"""

from __future__ import annotations

from tidewater.sources.fixtures import HAN_WORDS

# Name -> (dependencies, body).  Order of the dict is a valid definition order.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_log": ((), """
        select event_id as log_id,
               case when event_type = 'view' then 'startup' else 'event' end as type,
               'mid_' || cast(user_id % 30 as varchar) as mid,
               cast(user_id as varchar) as uid,
               'area_' || cast(user_id % 10 as varchar) as area,
               epoch_us(ts) // 1000 as ts,
               case event_type when 'purchase' then 'coupon' when 'click' then 'clickItem'
                               when 'signup' then 'addFavor' when 'error' then 'addComment' end as evid,
               json_extract_string(props, '$.k') as itemid
        from events"""),
    "v_dated": (("v_log",), """
        select *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') as logdate,
                  strftime(make_timestamp(ts * 1000), '%H') as loghour
        from v_log"""),
    "v_startup": (("v_dated",), "select * from v_dated where type = 'startup'"),
    "v_event": (("v_dated",), "select * from v_dated where type <> 'startup'"),
    "v_dau": (("v_startup",), """
        select log_id, type, mid, uid, area, ts, evid, itemid, logdate, loghour
        from (select *, row_number() over (partition by mid, logdate order by ts, uid, log_id) as rn
              from v_startup)
        where rn = 1"""),
    "v_order0": ((), """
        select cast(o_orderkey as varchar) as id, o_orderkey, cast(o_custkey as varchar) as user_id,
               o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as create_ts,
               o_totalprice as total_amount, o_orderstatus as order_status,
               '138' || lpad(cast(o_custkey as varchar), 8, '0') as consignee_tel,
               cast(c_nationkey as varchar) as province_id
        from orders join customer on o_custkey = c_custkey"""),
    "v_order": (("v_order0",), """
        select *, strftime(create_ts, '%Y-%m-%d %H:%M:%S') as create_time,
                  strftime(create_ts, '%Y-%m-%d') as create_date,
                  strftime(create_ts, '%H') as create_hour
        from v_order0"""),
    "v_order_enriched": (("v_order",), """
        select id, user_id, province_id, order_status, total_amount,
               substr(consignee_tel, 1, 4) || '*******' as consignee_tel,
               create_time, create_date, create_hour
        from v_order"""),
    "v_detail": (("v_order",), """
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as id,
               o.id as order_id, cast(l_partkey as varchar) as sku_id, p_name as sku_name,
               cast(cast(l_extendedprice as decimal(18, 2)) as varchar) as order_price,
               l_shipdate, l_partkey, l_suppkey, l_quantity, l_linenumber,
               o.create_ts + to_seconds((l_orderkey * 31 + l_linenumber * 97) % 400 - 200) as arrival_ts
        from lineitem join part on l_partkey = p_partkey join v_order o on o.o_orderkey = l_orderkey"""),
    "v_product_han": ((), f"""
        select cast(p_partkey as varchar) as sku_id,
               array_to_string(list_transform(string_split(p_name, ' '),
                   lambda w: case w {' '.join(f"when '{k}' then '{v}'" for k, v in HAN_WORDS.items())} else w end), '') as sku_name
        from part"""),
    "v_user": ((), """
        select cast(c_custkey as varchar) as id,
               case c_custkey % 3 when 0 then 'F' when 1 then 'M' end as gender,
               date '1955-01-01' + cast((c_custkey * 37) % 18000 as integer) as birthday,
               c_mktsegment as user_level
        from customer where c_custkey % 7 <> 0"""),
    "v_raw_log": (("v_log",), """
        select log_id, ts as received_ms, type, mid, uid, area, evid, itemid,
               '{' || concat_ws(',', '"type":' || to_json(type)::varchar, '"mid":' || to_json(mid)::varchar,
                                '"uid":' || to_json(uid)::varchar, '"area":' || to_json(area)::varchar,
                                '"evid":' || to_json(evid)::varchar, '"itemid":' || to_json(itemid)::varchar,
                                '"seq":' || cast(log_id as varchar)) || '}' as line
        from v_log"""),
    "v_log_routed": (("v_raw_log",), """
        select log_id, received_ms,
               case when coalesce(json_extract_string(line, '$.type') = 'startup', false)
                    then 'GMALL_STARTUP' else 'GMALL_EVENT' end as topic,
               '{' || concat_ws(',', '"type":' || to_json(type)::varchar, '"mid":' || to_json(mid)::varchar,
                                '"uid":' || to_json(uid)::varchar, '"area":' || to_json(area)::varchar,
                                '"evid":' || to_json(evid)::varchar, '"itemid":' || to_json(itemid)::varchar,
                                '"seq":' || cast(log_id as varchar), '"ts":' || cast(received_ms as varchar)) || '}' as value
        from v_raw_log"""),
    "v_cdc": ((), """
        select 'order_info' as "table",
               case when o_orderkey % 17 = 0 then 'TRANSACTIONEND' else 'ROWDATA' end as entry_type,
               case o_orderkey % 5 when 3 then 'UPDATE' when 4 then 'DELETE' else 'INSERT' end as event_type,
               o_orderkey * 10 as seq,
               map(['id', 'user_id', 'total_amount', 'order_status', 'consignee_tel', 'create_time',
                    'consignee', 'payment_way', 'out_trade_no', 'trade_body', 'expire_time'],
                   [cast(o_orderkey as varchar), cast(o_custkey as varchar),
                    cast(cast(o_totalprice as decimal(18, 2)) as varchar), o_orderstatus,
                    '138' || lpad(cast(o_custkey as varchar), 8, '0'),
                    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
                    'Customer ' || cast(o_custkey as varchar), cast(o_custkey % 3 as varchar),
                    'T' || cast(o_orderkey as varchar), o_orderpriority,
                    strftime(o_orderdate + interval 1 day, '%Y-%m-%d %H:%M:%S')]) as after
        from orders
        union all
        select 'order_detail', case when (l_orderkey * 8 + l_linenumber) % 17 = 0 then 'TRANSACTIONEND' else 'ROWDATA' end,
               case (l_orderkey * 8 + l_linenumber) % 5 when 3 then 'UPDATE' when 4 then 'DELETE' else 'INSERT' end,
               (l_orderkey * 8 + l_linenumber) * 10,
               map(['id', 'order_id', 'sku_id', 'order_price', 'sku_num'],
                   [cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar), cast(l_orderkey as varchar),
                    cast(l_partkey as varchar), cast(cast(l_extendedprice as decimal(18, 2)) as varchar),
                    cast(cast(l_quantity as integer) as varchar)])
        from lineitem
        union all
        select 'user_info', case when c_custkey % 17 = 0 then 'TRANSACTIONEND' else 'ROWDATA' end, 'INSERT',
               c_custkey * 10,
               map(['id', 'login_name', 'user_level', 'gender', 'birthday'],
                   [cast(c_custkey as varchar), c_name, c_mktsegment,
                    case c_custkey % 3 when 0 then 'F' when 1 then 'M' end,
                    case when c_custkey % 10 <> 0
                         then strftime(date '1955-01-01' + cast((c_custkey * 37) % 18000 as integer), '%Y-%m-%d')
                         else 'unknown' end])
        from customer
        union all
        select 'user_info', 'ROWDATA', case when c_custkey % 3 = 2 then 'DELETE' else 'UPDATE' end,
               c_custkey * 10 + 5,
               map(['id', 'login_name', 'user_level', 'gender', 'birthday'],
                   [cast(c_custkey as varchar), c_name, lower(c_mktsegment),
                    case c_custkey % 3 when 0 then 'F' when 1 then 'M' end,
                    case when c_custkey % 10 <> 0
                         then strftime(date '1955-01-01' + cast((c_custkey * 37) % 18000 as integer), '%Y-%m-%d')
                         else 'unknown' end])
        from customer where c_custkey % 4 = 1
        union all
        select 'base_province', 'ROWDATA', 'INSERT', n_nationkey * 10,
               map(['id', 'name'], [cast(n_nationkey as varchar), n_name])
        from nation"""),
    "v_cdc_routed": (("v_cdc",), """
        select "table", seq,
               case when "table" = 'order_info' and event_type = 'INSERT' then 'GMALL_ORDER_INFO'
                    when "table" = 'order_detail' and event_type = 'INSERT' then 'GMALL_ORDER_DETAIL'
                    when "table" = 'user_info' and event_type in ('INSERT', 'UPDATE') then 'GMALL_USER_INFO'
               end as topic,
               to_json(after)::varchar as value
        from v_cdc
        where entry_type = 'ROWDATA'
          and ((("table" = 'order_info' or "table" = 'order_detail') and event_type = 'INSERT')
               or ("table" = 'user_info' and event_type in ('INSERT', 'UPDATE')))"""),
    "v_user_latest": (("v_cdc_routed",), """
        select id, login_name, user_level, birthday, gender, seq
        from (select json_extract_string(value, '$.id') as id,
                     json_extract_string(value, '$.login_name') as login_name,
                     json_extract_string(value, '$.user_level') as user_level,
                     try_cast(json_extract_string(value, '$.birthday') as date) as birthday,
                     json_extract_string(value, '$.gender') as gender, seq,
                     row_number() over (partition by json_extract_string(value, '$.id') order by seq desc) as rn
              from v_cdc_routed where topic = 'GMALL_USER_INFO')
        where rn = 1"""),
    "v_sale_inner": (("v_order", "v_detail"), """
        select d.id as order_detail_id, o.id as order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
               d.sku_name, cast(d.order_price as double) as sku_price, o.create_date as dt,
               d.l_shipdate, d.l_partkey, d.l_suppkey, d.l_quantity
        from v_order o join v_detail d on o.id = d.order_id"""),
    "v_sale_interval": (("v_order", "v_detail"), """
        select d.id as order_detail_id, o.id as order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
               d.sku_name, cast(d.order_price as double) as sku_price, o.create_date as dt
        from v_order o join v_detail d
          on o.id = d.order_id
         and d.arrival_ts between o.create_ts - interval 120 second and o.create_ts + interval 120 second"""),
    "v_sale_enriched_all": (("v_sale_inner", "v_user"), """
        select s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
               u.gender as user_gender,
               coalesce(cast(date_diff('day', u.birthday, date '2001-08-01') // 365 as integer), 0) as user_age,
               u.user_level, s.sku_price, s.sku_name, s.dt, s.l_shipdate, s.l_partkey, s.l_suppkey, s.l_quantity
        from v_sale_inner s left join v_user u on s.user_id = u.id"""),
    "v_sale_table": (("v_sale_enriched_all",), """
        select doc_id, order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender,
               user_age, user_level, sku_price, sku_name, dt
        from (select *, order_id || '_' || order_detail_id as doc_id,
                     row_number() over (partition by order_id, order_detail_id
                                        order by l_shipdate desc, l_partkey desc, l_suppkey desc,
                                                 l_quantity desc, sku_price desc) as rn
              from v_sale_enriched_all)
        where rn = 1"""),
    "v_sale_tokens": (("v_sale_table",), r"""
        select *, list_distinct(list_filter(regexp_split_to_array(lower(sku_name), '[^\p{L}\p{N}]+'),
                                            lambda t: t <> '')) as toks,
                  len(list_filter(regexp_split_to_array(lower(sku_name), '[^\p{L}\p{N}]+'),
                                  lambda t: t <> '')) as dl
        from v_sale_table"""),
    "v_sale_stream_table": (("v_order", "v_detail", "v_user"), """
        select doc_id, order_detail_id, order_id, order_status, create_time, user_id, sku_id, user_gender,
               user_age, user_level, sku_price, sku_name, dt
        from (select *, order_id || '_' || order_detail_id as doc_id,
                     row_number() over (partition by order_id, order_detail_id
                                        order by l_shipdate desc, l_partkey desc, l_suppkey desc,
                                                 l_quantity desc, sku_price desc) as rn
              from (select d.id as order_detail_id, o.id as order_id, o.order_status, o.create_time, o.user_id,
                           d.sku_id, u.gender as user_gender,
                           coalesce(cast(date_diff('day', u.birthday, date '2001-08-01') // 365 as integer), 0)
                               as user_age,
                           u.user_level, cast(d.order_price as double) as sku_price, d.sku_name, o.create_date as dt,
                           d.l_shipdate, d.l_partkey, d.l_suppkey, d.l_quantity
                    from v_order o
                    join v_detail d
                      on o.id = d.order_id
                     and d.arrival_ts between o.create_ts - interval 120 second and o.create_ts + interval 120 second
                    left join v_user u on o.user_id = u.id))
        where rn = 1"""),
    "v_user_history": (("v_user",), """
        select *, timestamp '1988-01-01' + to_seconds((cast(id as bigint) * 86413) % (2000 * 86400)) as valid_from from v_user
        union all
        select * replace (lower(user_level) as user_level),
               timestamp '1994-01-01' + to_seconds((cast(id as bigint) * 86413) % (700 * 86400))
        from v_user where cast(id as bigint) % 4 = 1
        union all
        select * replace ('vip ' || user_level as user_level),
               timestamp '1996-01-01' + to_seconds((cast(id as bigint) * 86413) % (700 * 86400))
        from v_user where cast(id as bigint) % 8 = 1"""),
    "v_order_write": (("v_order",), """
        select *, create_ts as written_ts from v_order
        union all select *, create_ts + interval 90 second from v_order where o_orderkey % 3 = 0"""),
    # A line that finds no order waits; lines that wait less than the time to live after one another are an island.
    "v_ttl_line": (("v_order_write", "v_detail"), """
        select d.*, w.met
        from v_detail d left join
             (select d.order_id, d.arrival_ts, max(w.written_ts) as met
              from (select distinct order_id, arrival_ts from v_detail) d join v_order_write w
                on w.id = d.order_id and w.written_ts between d.arrival_ts - interval 120 second and d.arrival_ts
              group by d.order_id, d.arrival_ts) w
          on w.order_id = d.order_id and w.arrival_ts = d.arrival_ts"""),
    "v_ttl_waiting": (("v_ttl_line",), """
        select order_id, arrival_ts, sum(fresh) over (partition by order_id order by arrival_ts) as island
        from (select order_id, arrival_ts,
                     case when arrival_ts - lag(arrival_ts) over (partition by order_id order by arrival_ts) <= interval 120 second
                          then 0 else 1 end as fresh
              from (select distinct order_id, arrival_ts from v_ttl_line where met is null))"""),
    "v_ttl_met_later": (("v_ttl_waiting",), """
        select order_id, arrival_ts, max(written_ts) as met
        from (select c.order_id, c.arrival_ts, w.written_ts, max(c2.arrival_ts) as rearmed
              from v_ttl_waiting c join v_order_write w on w.id = c.order_id and w.written_ts > c.arrival_ts
              join v_ttl_waiting c2 on c2.order_id = c.order_id and c2.island = c.island and c2.arrival_ts < w.written_ts
              group by c.order_id, c.arrival_ts, w.written_ts)
        where written_ts <= rearmed + interval 120 second group by order_id, arrival_ts"""),
    "v_sale_ttl": (("v_ttl_met_later",), """
        select doc_id, order_detail_id, order_id, order_status, create_time, user_id, sku_id, sku_name, sku_price, dt, order_ms
        from (select d.order_id || '_' || d.id as doc_id, d.id as order_detail_id, d.order_id, o.order_status, o.create_time,
                     o.user_id, d.sku_id, d.sku_name, cast(d.order_price as double) as sku_price, o.create_date as dt,
                     epoch_us(coalesce(d.met, l.met)) // 1000 as order_ms,
                     row_number() over (partition by d.order_id, d.id order by coalesce(d.met, l.met) desc, d.l_shipdate desc,
                                        d.l_partkey desc, d.l_suppkey desc, d.l_quantity desc, d.order_price desc) as rn
              from v_ttl_line d left join v_ttl_met_later l on l.order_id = d.order_id and l.arrival_ts = d.arrival_ts
              join v_order o on o.id = d.order_id
              where coalesce(d.met, l.met) is not null)
        where rn = 1"""),
}


def with_views(*names: str) -> str:
    """``WITH`` clause defining ``names`` and everything they depend on."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    return "with " + ",\n".join(f"{n} as ({VIEWS[n][1]})" for n in ordered) + "\n"
