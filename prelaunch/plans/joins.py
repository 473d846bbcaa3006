"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound for an explicit broadcast hint. Sides above it are left to
# the planner (sort-merge join, or AQE's runtime conversion when the real
# size turns out small).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (from file sizes and projections)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # e.g. Spark Connect: no JVM handle
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES,
                       size_of: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast when the estimated size is below ``max_bytes``.

    The estimate comes from the scanned file sizes scaled by the projected
    columns and filter selectivity, the same statistic the planner's own
    ``autoBroadcastJoinThreshold`` check uses. Without an estimate no hint
    is given and the planner (with AQE's runtime sizes) decides.

    ``size_of`` checks another frame instead: for a dimension built by
    many-to-one lookups (supplier -> nation -> region) the row count is
    that of its base scan, while the optimizer multiplies join inputs.
    """
    size = estimated_bytes(size_of if size_of is not None else df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def broadcast_if_few(table: DataFrame, row_bytes: int = 256, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast of a materialised (checkpointed) table when its counted rows, at ``row_bytes`` each, stay below
    ``max_bytes``; more rows are left to the planner."""
    return F.broadcast(table) if table.count() * row_bytes <= max_bytes else table
