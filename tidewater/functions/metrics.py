"""Numeric columns of the dashboard: ages, age bands, truncated percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._util import col as _col

# Fixed values that must equal the reference's output: age band labels,
# statistic titles and gender option names of the sale-detail answer.
AGE_UNDER_20 = "20岁以下"
AGE_20_TO_29 = "20岁到30岁"
AGE_30_PLUS = "30岁及30岁以上"
AGE_TITLE = "用户年龄占比"
GENDER_TITLE = "用户性别占比"
MALE = "男"
FEMALE = "女"
DAYS_PER_YEAR = 365


def age_years(birthday, asof) -> Column:
    """Whole 365-day years between two dates (not calendar age).

    Both sides are midnight-aligned dates, so the millisecond arithmetic of a
    plain integer division of elapsed days by 365 gives the same answer.
    """
    return int_div(F.datediff(_col(asof), _col(birthday)), F.lit(DAYS_PER_YEAR)).cast("int")


def age_band(age) -> Column:
    a = _col(age)
    return (
        F.when(a < 20, F.lit(AGE_UNDER_20))
        .when(a < 30, F.lit(AGE_20_TO_29))
        .otherwise(F.lit(AGE_30_PLUS))
    )


def int_div(a, b) -> Column:
    """Integer (truncating) division of two non-negative integer columns."""
    x, y = _col(a).cast("long"), _col(b).cast("long")
    return ((x - x % y) / y).cast("long")


def truncated_percent(count, total) -> Column:
    """Percent with one decimal, truncated: ``(count*1000 div total) / 10``."""
    return int_div(_col(count).cast("long") * F.lit(1000), total) / F.lit(10.0)


def remainder_percent(*parts) -> Column:
    """``100 - a - b ...`` in double arithmetic, not rounded."""
    out = F.lit(100.0)
    for p in parts:
        out = out - _col(p)
    return out
