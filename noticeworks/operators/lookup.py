"""Joins against lookup tables, broadcast only once they are shown to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both bounds. Reads at most ``rows`` + 1 rows of it."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns),
        F.lit(0),
    )
    n, b = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= rows and b <= size


def measured(lookup: DataFrame) -> DataFrame:
    """``lookup``, marked for broadcast if it is measured small. Spark plans the joins of an unmarked
    one by itself, and adaptive execution splits their hot keys."""
    return F.broadcast(lookup) if is_small(lookup) else lookup
