"""Coupon-abuse alerts over sliding windows.

A device raises an alert for a window when at least ``min_accounts`` distinct
accounts took a coupon on it and nobody clicked an item in that window.  The
alert carries the accounts, the coupon items and the window's events.

Scale notes
-----------
* Nothing collects a device's raw events.  The first aggregation is keyed by
  ``(window, mid, evid)`` and keeps only a count and the *distinct* coupon
  accounts/items (partial aggregation on the map side), so a device that
  holds a third of all rows is reduced before the shuffle.  The second level
  per ``(window, mid)`` sees at most (panes per window) x (event types) rows;
  panes are placed into windows and folded in one shuffle.
* Sliding windows are assembled from panes: each event is aggregated once
  into a tumbling pane of width ``gcd(window, slide)``, and a window is the
  union of its panes.  Stream state and shuffled rows shrink by the
  window/slide factor compared with assigning every event to every window
  it falls in (6 windows per event for 30 s / 5 s).
* The event list of the reference (every event id, duplicates kept, in
  arrival order) is returned as its multiset: ``evid:count`` pairs sorted by
  event id.  It carries the same information, is deterministic, and its size
  is bounded by the number of event types instead of the window's traffic.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import doc_id, log_date, minute_key

# Fixed values that must equal the reference's.
COUPON = "coupon"
CLICK_ITEM = "clickItem"
MIN_ACCOUNTS = 3
WINDOW = "30 seconds"
SLIDE = "5 seconds"


def with_event_time(events: DataFrame, ms_col: str = "ts") -> DataFrame:
    """Add ``event_ts`` (TIMESTAMP) from epoch ms for windows and watermarks."""
    return events.withColumn("event_ts", F.timestamp_millis(F.col(ms_col)))


def _is(evid: str) -> Column:
    return F.col("evid") == F.lit(evid)


_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000,
            "week": 604_800_000}


def duration_ms(text: str) -> int:
    """``'30 seconds'``, ``'1 hour'``, ``'6 hours'`` -> milliseconds."""
    amount, unit = text.strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(amount) * _UNIT_MS[unit])


def pane_ms(window: str, slide: str) -> int:
    return math.gcd(duration_ms(window), duration_ms(slide))


def pane_counts(events: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Per ``(pane, mid, evid)``: count and distinct coupon accounts/items.

    One row in, one pane out (a tumbling window), so this is the stateful
    aggregation a stream keeps; works on batch and streaming input.
    """
    pane = f"{pane_ms(window, slide)} milliseconds"
    return events.groupBy(F.window("event_ts", pane).alias("p"), "mid", "evid").agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.when(_is(COUPON), F.col("uid"))).alias("uids"),
        F.collect_set(F.when(_is(COUPON), F.col("itemid"))).alias("items"),
    )


def _placed_panes(panes: DataFrame, window: str, slide: str) -> DataFrame:
    """Each pane row copied to the windows that contain it (window starts are
    multiples of the slide, as in ``F.window``), keyed by ``w_start_ms``."""
    size, step, width = duration_ms(window), duration_ms(slide), pane_ms(window, slide)
    start_ms = F.unix_millis(F.col("p.start"))
    # Window starts s (multiples of the slide) with s <= pane start < s + size.
    first = start_ms - F.pmod(start_ms, F.lit(step))
    back = F.sequence(F.lit(0), F.lit((size - width) // step))
    w_start = F.explode(F.transform(back, lambda k: first - k * F.lit(step))).alias("w_start_ms")
    return panes.select(w_start, start_ms.alias("p_start_ms"), "mid", "evid", "n", "uids", "items").where(
        F.col("w_start_ms") + F.lit(size) > F.col("p_start_ms")  # only when size is not a multiple of slide
    )


def touched_windows(panes: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Distinct ``(window_start, mid)`` of the windows that contain a pane."""
    placed = _placed_panes(panes, window, slide).select("w_start_ms", "mid").distinct()
    return placed.select(
        F.date_format(F.timestamp_millis("w_start_ms"), "yyyy-MM-dd HH:mm:ss").alias("window_start"), "mid")


def _window_struct(size_ms: int) -> Column:
    return F.struct(
        F.timestamp_millis("w_start_ms").alias("start"),
        F.timestamp_millis(F.col("w_start_ms") + F.lit(size_ms)).alias("end"),
    ).alias("w")


def window_evid_counts_from_panes(panes: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Per ``(window, mid, evid)`` from pane rows: each pane is copied to the
    windows that contain it, then counts are summed and sets merged."""
    grouped = _placed_panes(panes, window, slide).groupBy("w_start_ms", "mid", "evid").agg(
        F.sum("n").alias("n"),
        F.array_distinct(F.flatten(F.collect_list("uids"))).alias("uids"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    return grouped.select(_window_struct(duration_ms(window)), "mid", "evid", "n", "uids", "items")


def window_evid_counts(events: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Per ``(window, mid, evid)`` the count and distinct coupon accounts and
    items (batch input; a stream keeps :func:`pane_counts` as its state)."""
    return window_evid_counts_from_panes(pane_counts(events, window, slide), window, slide)


def alerts_from_counts(counts: DataFrame, min_accounts: int = MIN_ACCOUNTS) -> DataFrame:
    """Second level: fold the per-event-type rows of a ``(window, mid)`` group
    and keep the groups that raise an alert."""
    grouped = counts.groupBy("w", "mid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("uids")))).alias("uids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.collect_list(F.concat_ws(":", F.col("evid"), F.col("n").cast("string")))).alias("events"),
        F.coalesce(F.bool_or(_is(CLICK_ITEM)), F.lit(False)).alias("clicked"),
    )
    fired = grouped.where((F.size("uids") >= min_accounts) & ~F.col("clicked"))
    return _alert_rows(fired)


def alerts_from_panes(panes: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                      min_accounts: int = MIN_ACCOUNTS) -> DataFrame:
    """Alerts straight from pane rows with one grouping per ``(window, mid)``
    (one shuffle instead of two: :func:`window_evid_counts_from_panes`
    followed by :func:`alerts_from_counts` gives the same rows).

    Per-event-type counts are summed inside the group from a list of
    ``(evid, n)`` pairs; that list holds at most (panes per window) x (event
    types) entries, whatever the device's traffic.
    """
    grouped = _placed_panes(panes, window, slide).groupBy("w_start_ms", "mid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("uids")))).alias("uids"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.collect_list(F.struct("evid", "n")).alias("_ev"),
        F.coalesce(F.bool_or(_is(CLICK_ITEM)), F.lit(False)).alias("clicked"),
    )
    fired = grouped.where((F.size("uids") >= min_accounts) & ~F.col("clicked"))

    def evid_total(e: Column) -> Column:
        same = F.filter("_ev", lambda x: x["evid"].eqNullSafe(e))
        return F.aggregate(same, F.lit(0).cast("long"), lambda acc, x: acc + x["n"])

    events = F.array_sort(F.transform(
        F.array_distinct(F.transform("_ev", lambda x: x["evid"])),
        lambda e: F.concat_ws(":", e, evid_total(e).cast("string")),
    ))
    return _alert_rows(fired.select(_window_struct(duration_ms(window)), "mid", "uids", "items",
                                    events.alias("events")))


def _alert_rows(fired: DataFrame) -> DataFrame:
    return fired.select(
        "mid",
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        F.array_join("uids", ",").alias("uids"),
        F.array_join("items", ",").alias("item_ids"),
        F.array_join("events", ",").alias("events"),
        # Event-time stamp (the window end) instead of the wall clock.
        F.unix_millis("w.end").alias("ts"),
    )


def coupon_alerts(
    events: DataFrame, window: str = WINDOW, slide: str = SLIDE, min_accounts: int = MIN_ACCOUNTS
) -> DataFrame:
    """Event logs (``mid, uid, evid, itemid, ts`` in ms) -> alert rows."""
    return alerts_from_panes(pane_counts(with_event_time(events), window, slide), window, slide, min_accounts)


def alert_doc_ids(alerts: DataFrame) -> DataFrame:
    """Index day and document id ``mid-HH:mm`` of each alert (one document a
    device and minute; the index is per day)."""
    return alerts.withColumn("day", log_date("ts")).withColumn("doc_id", doc_id("-", "mid", minute_key("ts")))


def latest_alert_per_doc(alerts: DataFrame) -> DataFrame:
    """Suppression: the last alert (by ``ts``) of each ``(day, doc_id)`` wins."""
    keyed = alert_doc_ids(alerts)
    rest = [c for c in keyed.columns if c not in ("day", "doc_id")]
    last = keyed.groupBy("day", "doc_id").agg(F.max_by(F.struct(*rest), F.col("ts")).alias("_a"))
    return last.select("day", "doc_id", *[F.col(f"_a.{c}").alias(c) for c in rest])
