"""Order ⋈ order line through caches whose time to live is re-armed.

Each side of an order waits for the other in a cache.  An order is kept for the
time to live after its last write; a line that finds no order joins its order's
waiting lines, and each line that joins them keeps all of them for another time to
live.  A line can so meet an order that comes much later than the time to
live, if lines kept arriving in between; :func:`tidewater.operators.sales.interval_join`
bounds each pair by itself.

Nothing of one order affects what comes after a silence longer than the time to
live, so the rows of an order between two silences are a session: the session window's
gap is the re-armed timer, and a session is over when the watermark passes it.  Its rows, in
order of arrival, are folded with the cache rules.  A stream gives the pairs of the sessions
that are over and keeps the rows of the others (:func:`open_rows`) for its next batch, so its
answer does not depend on how its input is cut into micro-batches, nor on the order inside the
lateness allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.sales import JOIN_WAIT_SECONDS
from tidewater.plans.strategy import broadcast_if_few


def gap_ms(ttl_seconds: int) -> int:
    """A millisecond more than the bound, which is inclusive; the fold compares exactly."""
    return ttl_seconds * 1000 + 1


def _lives(arrivals: DataFrame, ttl_seconds: int, partitions: int | None = None) -> DataFrame:
    """The sessions of every order with their rows in order of arrival and the time when they are over (a value
    of its own: a test of the window would be pushed down to single rows, which are not yet merged).
    Rows without an order id, or without a time, meet nothing.  Rows cross the shuffle as they are (into
    ``partitions``, or as many as the session has), not as lists of one row, which take half as much again."""
    row = F.struct(F.unix_millis("ts").alias("ms"), F.col("o").isNull().cast("int").alias("side"), "o", "d", "ts")
    session = F.session_window("ts", f"{gap_ms(ttl_seconds)} milliseconds")
    known = arrivals.where("order_id is not null")
    known = known.repartition(partitions, "order_id") if partitions else known.repartition("order_id")
    return known.groupBy("order_id", session).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), (F.unix_millis(F.max("ts")) + gap_ms(ttl_seconds)).alias("over_ms"))


def open_rows(arrivals: DataFrame, upto: int, ttl_seconds: int = JOIN_WAIT_SECONDS) -> DataFrame:
    """The arrivals of sessions that are not over at ``upto`` (milliseconds)."""
    recent = arrivals.where(F.unix_millis("ts") + gap_ms(ttl_seconds) > upto).select(F.col("order_id").alias("_id")).distinct()
    # Usually the orders of the last minutes: then the arrivals are not shuffled to find theirs.
    near = arrivals.join(broadcast_if_few(recent), F.col("order_id") == F.col("_id"), "left_semi")
    left = _lives(near, ttl_seconds).where(F.col("over_ms") > upto)
    return left.select("order_id", F.inline("rows")).select(*arrivals.columns)


def ttl_join(arrivals: DataFrame, ttl_seconds: int = JOIN_WAIT_SECONDS, upto: int | None = None,
             partitions: int | None = None) -> DataFrame:
    """(order_id, order_ms, o, d): every pair the caches bring together.

    ``arrivals``: order_id, ts, and the record as a struct, ``o`` of an order's write or ``d``
    of a line (the other is null).  An order written again meets the lines still waiting
    again, so a pair may appear once a write: ``order_ms``, the write's time, orders
    them.  At the same time an order comes before a line.  Rows without an order id meet
    nothing.  With ``upto`` (milliseconds) only pairs of sessions that are over by then.
    """
    ttl = ttl_seconds * 1000
    lives = _lives(arrivals, ttl_seconds, partitions)
    if upto is not None:
        lives = lives.where(F.col("over_ms") <= upto)
    types = {c: arrivals.schema[c].dataType.simpleString() for c in ("o", "d")}
    return lives.select("order_id", F.inline(_folded(F.col("rows"), ttl, types)))


def _folded(rows: Column, ttl: int, types: dict[str, str]) -> Column:
    """The pairs of a session's rows, which are in order of arrival."""
    o_type, d_type = types["o"], types["d"]
    nothing = F.struct(
        F.lit(None).cast("bigint").alias("order_ms"), F.lit(None).cast(o_type).alias("o"),
        F.array().cast(f"array<{d_type}>").alias("waiting"), F.lit(None).cast("bigint").alias("last_ms"),
        F.array().cast(f"array<struct<order_ms:bigint,o:{o_type},d:{d_type}>>").alias("pairs"))

    def step(at: Column, row: Column) -> Column:
        now = row["ms"]
        waiting = F.when(at["last_ms"] >= now - ttl, at["waiting"]).otherwise(F.array().cast(f"array<{d_type}>"))
        met = F.transform(waiting, lambda d: F.struct(now.alias("order_ms"), row["o"].alias("o"), d.alias("d")))
        order = F.struct(
            now.alias("order_ms"), row["o"].alias("o"), waiting.alias("waiting"), at["last_ms"].alias("last_ms"),
            F.concat(at["pairs"], met).alias("pairs"))
        pair = F.struct(at["order_ms"].alias("order_ms"), at["o"].alias("o"), row["d"].alias("d"))
        direct = F.struct(
            at["order_ms"].alias("order_ms"), at["o"].alias("o"), at["waiting"].alias("waiting"),
            at["last_ms"].alias("last_ms"), F.concat(at["pairs"], F.array(pair)).alias("pairs"))
        cached = F.struct(
            at["order_ms"].alias("order_ms"), at["o"].alias("o"), F.concat(waiting, F.array(row["d"])).alias("waiting"),
            now.alias("last_ms"), at["pairs"].alias("pairs"))
        return F.when(row["side"] == 0, order).when(at["order_ms"] >= now - ttl, direct).otherwise(cached)

    return F.aggregate(rows, nothing, step, lambda at: at["pairs"])
