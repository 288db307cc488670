"""Dashboard answers: metric cards and today-versus-yesterday hour series.

Both answers are tiny (3 and 24 rows); the work is the filtered aggregation
under them, which reads only the days asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import day_before

# Fixed values that must equal the reference's: metric card ids and names.
CARD_DAU = ("dau", "新增日活")
CARD_NEW_MID = ("new_mid", "新增设备")
CARD_ORDER_AMOUNT = ("order_amount", "新增交易额")
HOURS = 24


# Defaults of an empty request parameter.
DEFAULT_DATE = "2019-03-04"
DEFAULT_KEYWORD = ""


def request_params(date: str | None, keyword: str | None) -> tuple[str, str]:
    """Driver-side defaults for the dashboard's query parameters."""
    return (date or DEFAULT_DATE, keyword if keyword else DEFAULT_KEYWORD)


def metric_cards(dau_count: DataFrame, new_mid_count: DataFrame, order_amount: DataFrame) -> DataFrame:
    """Three one-row aggregates -> rows ``(id, name, value)`` (a union of
    one-row results; each input is a one-column, one-row DataFrame)."""
    def card(df: DataFrame, ident: tuple[str, str]) -> DataFrame:
        value = F.col(df.columns[0]).cast("double")
        return df.select(F.lit(ident[0]).alias("id"), F.lit(ident[1]).alias("name"), value.alias("value"))

    return (
        card(dau_count, CARD_DAU)
        .unionByName(card(new_mid_count, CARD_NEW_MID))
        .unionByName(card(order_amount, CARD_ORDER_AMOUNT))
    )


def hour_axis(spark: SparkSession) -> DataFrame:
    """The fixed 24-row axis ``00`` .. ``23``."""
    return spark.range(HOURS).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def today_vs_yesterday(
    spark: SparkSession, by_day_hour: DataFrame, date: str,
    day_col: str, hour_col: str, value_col: str, fill=0,
) -> DataFrame:
    """Align ``date`` and the day before by hour over the full 24-hour axis.

    ``by_day_hour`` holds one value per (day, hour) for at least the two
    days; missing hours become ``fill``.  The two days are folded into two columns
    with conditional sums (one pass), then the 24-row axis is joined to the
    at most 24 aggregated rows (both sides bounded by 24: broadcast-safe).
    """
    yday = day_before(date)
    two_days = by_day_hour.where(F.col(day_col).isin(date, yday))
    folded = two_days.groupBy(F.col(hour_col).alias("hour")).agg(
        F.sum(F.when(F.col(day_col) == date, F.col(value_col))).alias("today"),
        F.sum(F.when(F.col(day_col) == yday, F.col(value_col))).alias("yesterday"),
    )
    return hour_axis(spark).join(F.broadcast(folded), "hour", "left").select(
        "hour",
        F.coalesce(F.col("today"), F.lit(fill)).alias("today"),
        F.coalesce(F.col("yesterday"), F.lit(fill)).alias("yesterday"),
    )


def hour_maps_json(series: DataFrame) -> DataFrame:
    """The reference's answer shape: one JSON text
    ``{"yesterday": {hour: value}, "today": {hour: value}}`` with the hours
    that have a value (0 is one), in hour order.  The input is the 24-row series with
    null for hours without value (``fill=None``)."""
    def day_map(col: str):
        entries = F.array_sort(F.collect_list(F.when(F.col(col).isNotNull(), F.struct("hour", col))))
        return F.map_from_entries(entries).alias(col)

    return series.agg(day_map("yesterday"), day_map("today")).select(
        F.to_json(F.struct("yesterday", "today")).alias("json")
    )
