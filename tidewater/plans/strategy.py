"""Physical-strategy helpers: size-checked broadcast.

A side is broadcast only when Catalyst's size estimate of its optimized plan
is under a bound; otherwise the join is left to the planner (sort-merge or
shuffled hash) and to AQE, which re-checks the runtime size of each side after
its shuffle and can still switch to a broadcast then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast copy is shipped to every executor and held in memory there.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# File-based estimates count compressed bytes on disk; decoded rows take more.
DECODE_INFLATION = 5


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (None if unavailable)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # Spark Connect or an unexpected plan: no estimate
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its estimated size is proven small."""
    size = estimated_bytes(df)
    if size is not None and size * DECODE_INFLATION <= max_bytes:
        return F.broadcast(df)
    return df


# Rows a counted side may have to be broadcast (about 100 bytes a row).
DEFAULT_BROADCAST_ROWS = 500_000


def broadcast_if_few(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if a count proves it has at most
    ``max_rows`` rows.

    For sides whose size Catalyst cannot bound (a selective filter without
    column statistics is estimated at the size of the whole scan), e.g. the
    orders of one day.  The count is a partial count per task; a large side
    takes the shuffled join.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
