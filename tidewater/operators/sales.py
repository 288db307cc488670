"""Sale detail: order ⋈ order line with late arrival, user enrichment and the
keyed upsert of the wide rows.

Scale notes
-----------
* The order/line joins are equi-joins on the order id (the time bound is an
  extra condition on the joined pair), so they shuffle both sides once on the
  key; AQE splits a skewed order id's partition on the line side.  The full
  outer join is rewritten so that this splitting still applies.
* The user dimension is broadcast only when its estimated size is proven
  small; otherwise it is a shuffled left join.  :func:`with_user_fields` also takes
  orders, so that the users cross a shuffle with them and not with each of their lines.
* The upsert keeps the newest row per document id with a grouped ``max_by``.  A document is a
  line of one order, so it is grouped by order id and document id: rows that were joined on the
  order id are where the grouping needs them and are not shuffled again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import age_years, doc_id
from tidewater.operators.asof import asof_join
from tidewater.plans.strategy import broadcast_if_small

JOIN_WAIT_SECONDS = 120  # fixed value: how long either side waits for the other

SALE_COLUMNS = (
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
)


USER_COLUMNS = ("user_gender", "user_age", "user_level")


def _order_side(orders: DataFrame, extra=()) -> DataFrame:
    return orders.select(
        F.col("id").alias("o_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"), F.col("create_ts").alias("o_ts"), *extra,
    )


def _detail_side(details: DataFrame, extra=()) -> DataFrame:
    return details.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("d_order_id"), "sku_id", "sku_name",
        F.col("order_price").cast("double").alias("sku_price"), F.col("arrival_ts").alias("d_ts"), *extra,
    )


def _wide(joined: DataFrame, extra=()) -> DataFrame:
    return joined.select(
        "order_detail_id", F.col("o_id").alias("order_id"), "order_status", "create_time", "user_id",
        "sku_id", "sku_name", "sku_price", "dt", *extra,
    )


def interval_join(orders: DataFrame, details: DataFrame, wait_seconds: int = JOIN_WAIT_SECONDS, extra=(),
                  order_extra=()) -> DataFrame:
    """Pairs of an order and a line of it that arrived within ``wait_seconds``
    of each other (either may come first); unmatched rows are dropped.  ``extra`` columns of the
    line and ``order_extra`` columns of the order are kept."""
    o, d = _order_side(orders, order_extra), _detail_side(details, extra)
    bound = F.expr(f"INTERVAL {int(wait_seconds)} SECONDS")
    cond = (
        (o.o_id == d.d_order_id)
        & (d.d_ts >= o.o_ts - bound)
        & (d.d_ts <= o.o_ts + bound)
    )
    return _wide(o.join(d, cond, "inner"), (*order_extra, *extra))


def inner_join(orders: DataFrame, details: DataFrame, extra=(), order_extra=()) -> DataFrame:
    """Every line with its order (no time bound: all records have arrived)."""
    o, d = _order_side(orders, order_extra), _detail_side(details, extra)
    return _wide(o.join(d, o.o_id == d.d_order_id, "inner"), (*order_extra, *extra))


def full_outer_join(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders and lines matched on order id; unmatched rows of both sides kept.

    Written as ``lines LEFT JOIN orders`` plus the orders that no line
    names (anti join against the *distinct* order ids of the lines).  The
    result equals a FULL OUTER JOIN, but AQE can split a hot order id of the
    left join over several tasks (it cannot for a full outer join), and the
    distinct ids are reduced map-side before the anti join's shuffle.
    """
    o, d = _order_side(orders), _detail_side(details)
    matched = d.join(o, d.d_order_id == o.o_id, "left")
    line_ids = d.select(F.col("d_order_id").alias("_id")).distinct()
    lonely = o.join(line_ids, o.o_id == line_ids._id, "left_anti")
    cols = ["order_detail_id", "order_status", "create_time", "user_id", "sku_id", "sku_price", "dt"]
    left_part = matched.select(F.coalesce("o_id", "d_order_id").alias("order_id"), *cols)
    right_part = lonely.select(
        F.col("o_id").alias("order_id"), F.lit(None).cast("string").alias("order_detail_id"), "order_status",
        "create_time", "user_id", F.lit(None).cast("string").alias("sku_id"),
        F.lit(None).cast("double").alias("sku_price"), "dt",
    )
    return left_part.unionByName(right_part)


def with_user_fields(rows: DataFrame, users: DataFrame, asof: str) -> DataFrame:
    """Rows with a ``user_id`` and the fields of their user; a miss keeps the row with
    age 0 and null gender/level (the reference's defaults)."""
    u = users.select(
        F.col("id").alias("u_id"), F.col("gender").alias("user_gender"),
        age_years("birthday", F.lit(asof).cast("date")).alias("u_age"), F.col("user_level"),
    )
    joined = rows.join(broadcast_if_small(u), rows.user_id == u.u_id, "left")
    return joined.withColumn("user_age", F.coalesce(F.col("u_age"), F.lit(0))).drop("u_id", "u_age")


def enrich_with_users(sales: DataFrame, users: DataFrame, asof: str) -> DataFrame:
    """Overlay user fields when the user exists (:func:`with_user_fields`)."""
    extra = [c for c in sales.columns if c not in SALE_COLUMNS]
    return with_user_fields(sales, users, asof).select(*SALE_COLUMNS, *extra)


def enrich_with_user_versions(sales: DataFrame, history: DataFrame, asof: str) -> DataFrame:
    """As :func:`enrich_with_users`, with the user as known when the order was placed: ``history``
    has a user's versions (id, gender, birthday, user_level) with their ``valid_from``."""
    versions = history.select(F.col("id").alias("user_id"), "valid_from", "gender", "birthday", "user_level")
    placed = sales.withColumn("_placed", F.to_timestamp("create_time"))
    joined = asof_join(placed, versions, "user_id", "_placed", "valid_from")
    age = age_years(F.col("version.birthday"), F.lit(asof).cast("date"))
    out = joined.withColumns({
        "user_gender": F.col("version.gender"), "user_level": F.col("version.user_level"), "user_age": F.coalesce(age, F.lit(0))})
    extra = [c for c in sales.columns if c not in SALE_COLUMNS]
    return out.select(*SALE_COLUMNS, *extra)


def with_doc_id(sales: DataFrame) -> DataFrame:
    return sales.withColumn("doc_id", doc_id("_", "order_id", "order_detail_id"))


def latest_per_doc(sales: DataFrame, version_cols) -> DataFrame:
    """One row per ``doc_id``: the newest by ``version_cols`` (descending)."""
    keyed = with_doc_id(sales)
    rest = [c for c in keyed.columns if c not in ("doc_id", "order_id")]
    version = F.struct(*[F.col(c) for c in version_cols])
    last = keyed.groupBy("order_id", "doc_id").agg(F.max_by(F.struct(*rest), version).alias("_s"))
    return last.select(*[c if c in ("doc_id", "order_id") else F.col(f"_s.{c}").alias(c) for c in ("doc_id", *[
        c for c in keyed.columns if c != "doc_id"])])
