"""Size checks that decide a physical strategy before the plan is built.

Catalyst plans a small side as a shuffle join when its own threshold is low
or the side is derived. ``plan_bytes`` reads the optimizer's statistics of a
frame: file sizes for a staged or scanned table, carried upward as a bound
through filters, projections and aggregates. No job runs and the input is not
evaluated. A frame derived from joins is bounded by a product and counts as
large; stage it first to have its real size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Estimated bytes of a frame that are safe to broadcast (files are compressed; hashed rows take several times as much).
BROADCAST_BYTES = 32 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size bound of ``df`` in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size bound is at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df
