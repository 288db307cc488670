"""Daily active devices: first start of a device per day, seen-set anti join,
totals per day and per hour, new devices.

Scale notes
-----------
* The first start per ``(mid, logdate)`` is a grouped ``min`` over a struct
  whose leading field is ``ts``: it keeps a partial aggregate on the map side,
  so a device that holds a third of all rows is reduced inside each input
  partition before anything is shuffled (a ``row_number`` window would instead
  shuffle and sort every row of that device into a single task).
* The seen-set anti join broadcasts the seen pairs only behind a size check;
  beyond it the planner shuffles both sides on ``(mid, logdate)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import log_date, log_hour
from tidewater.plans.strategy import broadcast_if_small

DAU_KEYS = ("mid", "logdate")
# Total order used to pick the first record of a group: ts first, then the
# remaining identifying columns so that ties on ts do not depend on arrival.
FIRST_ORDER = ("ts", "uid", "log_id")


def with_log_time(logs: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Add ``logdate`` (yyyy-MM-dd) and ``loghour`` (HH) from epoch ms."""
    return logs.withColumn("logdate", log_date(ts_col)).withColumn("loghour", log_hour(ts_col))


def first_per_key(df: DataFrame, keys=DAU_KEYS, order=FIRST_ORDER) -> DataFrame:
    """The first row of each key group by ``order`` (works on streams too)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [c for c in order if c in df.columns]
    first = F.min(F.struct(*[F.col(c) for c in ordered + rest])).alias("_first")
    out = df.groupBy(*keys).agg(first)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in ordered + rest]).select(*df.columns)


def first_start_per_day(startup_logs: DataFrame) -> DataFrame:
    """DAU rows: the first start of every device on every day."""
    return first_per_key(with_log_time(startup_logs), DAU_KEYS, FIRST_ORDER)


def seen_pairs(dated_logs: DataFrame) -> DataFrame:
    """Distinct ``(mid, logdate)`` pairs (the per-day seen-device set)."""
    return dated_logs.select(*DAU_KEYS).distinct()


def drop_seen(dated_logs: DataFrame, seen: DataFrame, null_is_key: bool = False) -> DataFrame:
    """Anti join: keep logs whose ``(mid, logdate)`` is not in ``seen``; with
    ``null_is_key`` a null device matches a null device."""
    pairs = broadcast_if_small(seen.select(*DAU_KEYS))
    if not null_is_key:
        return dated_logs.join(pairs, list(DAU_KEYS), "left_anti")
    pairs = pairs.select(F.col("mid").alias("_mid"), F.col("logdate").alias("_logdate"))
    return dated_logs.join(
        pairs, F.col("mid").eqNullSafe(F.col("_mid")) & F.col("logdate").eqNullSafe(F.col("_logdate")), "left_anti")


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """``count(*)`` of DAU rows on ``date`` (0 when there are none)."""
    return dau.where(F.col("logdate") == date).agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame, date: str) -> DataFrame:
    """DAU rows on ``date`` counted per ``loghour``."""
    return (
        dau.where(F.col("logdate") == date)
        .groupBy("loghour")
        .agg(F.count(F.lit(1)).alias("ct"))
    )


def new_devices_by_day(dau: DataFrame) -> DataFrame:
    """Devices whose first-ever ``logdate`` is the day, counted per day."""
    first_day = dau.groupBy("mid").agg(F.min("logdate").alias("logdate"))
    return first_day.groupBy("logdate").agg(F.count(F.lit(1)).alias("new_mid"))


def new_devices_on(dau: DataFrame, date: str) -> DataFrame:
    """Number of devices first seen on ``date`` (one row, 0 if none)."""
    first_day = dau.groupBy("mid").agg(F.min("logdate").alias("first_day"))
    return first_day.where(F.col("first_day") == date).agg(F.count(F.lit(1)).alias("new_mid"))


def count_stage(df: DataFrame, name: str) -> DataFrame:
    """Count the rows passing a stage as a side metric of the same job
    (``df.observe``), instead of a separate ``count()`` action."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def first_arrival_per_day(dated_logs: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Streaming dedup that keeps the first *arrival* per ``(mid, logdate)``;
    state older than the watermark is dropped (rows later than ``lateness``
    are dropped too).  ``dated_logs`` needs an ``event_ts`` timestamp."""
    return dated_logs.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(list(DAU_KEYS))
