"""The four equi-join kinds of the reference's join demo, on keyed pairs.

``pair_join`` is the generic form (key, left value, right value).  The
registered demo joins each device's day to the same device's previous day:
keys are unique on both sides, so no join fans out, and the four kinds mean
"active both days" (inner), "active today" (left), "active yesterday"
(right) and either (full).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOIN_KINDS = {"inner": "inner", "left": "left", "right": "right", "full": "full_outer"}


def pair_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join ``(keys…, lv)`` with ``(keys…, rv)``; keys are coalesced so outer
    rows keep their key from whichever side has it.
    """
    how = JOIN_KINDS.get(how, how)
    lk = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], "lv")
    rk = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "rv")

    def cond(a: DataFrame, a_prefix: str, b: DataFrame, b_prefix: str):
        out = None
        for k in keys:
            c = a[f"{a_prefix}{k}"] == b[f"{b_prefix}{k}"]
            out = c if out is None else out & c
        return out

    out_cols = [F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys]
    return lk.join(rk, cond(lk, "_l_", rk, "_r_"), how).select(*out_cols, "lv", "rv")


def day_over_day(dau: DataFrame, how: str) -> DataFrame:
    """Each device-day joined to the same device's previous day."""
    today = dau.select("mid", F.col("logdate").alias("day"), F.col("uid").alias("lv"))
    prev = dau.select(
        "mid",
        F.date_format(F.date_add(F.to_date("logdate"), 1), "yyyy-MM-dd").alias("day"),
        F.col("uid").alias("rv"),
    )
    out = pair_join(today, prev, ["mid", "day"], how)
    return out.select("mid", "day", F.col("lv").alias("today_uid"), F.col("rv").alias("yesterday_uid"))
