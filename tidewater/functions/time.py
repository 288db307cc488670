"""Date and time columns (epoch milliseconds, log dates and hours, minute keys).

All functions take and return Columns; formatting happens in the session time
zone, which :func:`tidewater.session.prepare_session` pins to UTC.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._util import col as _col


def epoch_ms(ts) -> Column:
    """Timestamp (also TIMESTAMP_NTZ) -> epoch milliseconds (floored)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def ms_to_timestamp(ms) -> Column:
    return F.timestamp_millis(_col(ms))


def log_date(ms) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` string."""
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyy-MM-dd")


def log_hour(ms) -> Column:
    """Epoch ms -> two-digit hour string ``HH``."""
    return F.date_format(F.timestamp_millis(_col(ms)), "HH")


def minute_key(ms) -> Column:
    """Epoch ms -> ``HH:mm`` (the alert suppression key)."""
    return F.date_format(F.timestamp_millis(_col(ms)), "HH:mm")


def date_part_of(datetime_str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``yyyy-MM-dd`` by splitting on the blank."""
    return F.split(_col(datetime_str), " ").getItem(0)


def hour_part_of(datetime_str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``HH`` by splitting twice."""
    return F.split(F.split(_col(datetime_str), " ").getItem(1), ":").getItem(0)


def format_datetime(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def day_before(date_str: str) -> str:
    """``yyyy-MM-dd`` -> the previous day, same format (a driver-side parameter)."""
    return (_dt.date.fromisoformat(date_str) - _dt.timedelta(days=1)).isoformat()


def day_after(date_str: str) -> str:
    return (_dt.date.fromisoformat(date_str) + _dt.timedelta(days=1)).isoformat()


def day_bounds_ms(date_str: str) -> tuple[int, int]:
    """Epoch-ms half-open range ``[start, end)`` of a UTC day.

    Used to add a range predicate on the raw timestamp next to an equality on
    the derived date string, so the scan can skip row groups.
    """
    day = _dt.datetime.combine(_dt.date.fromisoformat(date_str), _dt.time(), _dt.timezone.utc)
    start = int(day.timestamp() * 1000)
    return start, start + 86_400_000


def day_bounds_ts(date_str: str, days: int = 1) -> tuple[_dt.datetime, _dt.datetime]:
    """Naive UTC datetimes ``[start, start + days)`` for TIMESTAMP_NTZ columns."""
    start = _dt.datetime.combine(_dt.date.fromisoformat(date_str), _dt.time())
    return start, start + _dt.timedelta(days=days)


def today() -> Column:
    """Today's date as ``yyyy-MM-dd`` (the query's start time, session zone)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def or_default(value, default) -> Column:
    """An empty or missing request value falls back to ``default``."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(default))
