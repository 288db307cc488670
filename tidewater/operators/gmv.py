"""Gross merchandise value: order enrichment, totals per day and hour, and
sales per province."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import date_part_of, hour_part_of, int_div, mask_phone

ORDER_COLUMNS = (
    "id", "user_id", "province_id", "order_status", "total_amount",
    "consignee_tel", "create_time", "create_date", "create_hour",
)
# Fixed value: colour-band width of the province map.
PROVINCE_BAND = 100


def enrich_orders(orders: DataFrame) -> DataFrame:
    """Derive ``create_date``/``create_hour`` from ``create_time`` and mask the phone."""
    return (
        orders.withColumn("create_date", date_part_of("create_time"))
        .withColumn("create_hour", hour_part_of("create_time"))
        .withColumn("consignee_tel", mask_phone("consignee_tel"))
    )


def gmv_total(orders: DataFrame, date: str) -> DataFrame:
    """``sum(total_amount)`` on ``date`` (null when there are no orders)."""
    return orders.where(F.col("create_date") == date).agg(
        F.sum("total_amount").cast("double").alias("sum_amount")
    )


def gmv_by_hour(orders: DataFrame, date: str) -> DataFrame:
    return (
        orders.where(F.col("create_date") == date)
        .groupBy("create_hour")
        .agg(F.sum("total_amount").cast("double").alias("sum_amount"))
    )


def gmv_by_province(orders: DataFrame) -> DataFrame:
    """Order count and amount per province, with a map colour band of the count."""
    agg = orders.groupBy("province_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("order_amount"),
    )
    return agg.withColumn("band", int_div("order_count", F.lit(PROVINCE_BAND)).cast("int"))
