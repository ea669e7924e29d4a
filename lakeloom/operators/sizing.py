"""Broadcast only what is proven small.

By default the library adds no broadcast hint: Spark's own size check
decides -- the planner's estimate (``spark.sql.autoBroadcastJoinThreshold``)
and, once a shuffle has run, AQE's measured size of the shuffled side
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), which turns a planned
sort-merge join into a broadcast join only when the bytes are really small.
Callers who know a side is a bounded lookup list can ask for an explicit
row-count check instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# None: leave the choice to the planner and AQE (measured sizes).
DEFAULT_BROADCAST_MAX_ROWS: int | None = None


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Each partition stops reading after ``max_rows + 1`` rows, so use it on
    lookup-sized inputs; on a large table it can read most of the input.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is within ``max_rows``, else ``df``
    unchanged. ``max_rows=None`` skips the probe and leaves the choice to
    the planner and AQE."""
    if max_rows is None:
        return df
    return F.broadcast(df) if is_small(df, max_rows) else df
