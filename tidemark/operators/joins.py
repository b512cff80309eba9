"""Joining a big, possibly skewed side with a small lookup table.

Lookup tables here have one row per branch, per file or per hot key. Their key
is exactly what the big side is skewed on, so a shuffle join would put a hot
branch (or a huge file) into one partition. ``join_small`` broadcasts the small
side only after proving its size: a ``limit(n + 1)`` count where ``n`` is the
smaller of a row cap and a byte budget divided by the schema's row-size
estimate, so wide tables get a proportionally smaller row cap.
Beyond the bound it falls back to a plain join, where AQE's skew-join handling
splits oversized partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 200_000
DEFAULT_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> int:
    """Spark's per-row size estimate for the schema (``StructType.defaultSize``)."""
    try:
        return max(1, int(df._jdf.schema().defaultSize()))
    except Exception:  # noqa: BLE001 - non-JVM sessions: assume a wide row
        return 1024


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """At most ``max_rows`` rows and about ``max_bytes``; examines at most
    ``limit + 1`` rows."""
    limit = max(1, min(max_rows, max_bytes // row_bytes(df)))
    return df.limit(limit + 1).count() <= limit


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``big.join(small)``, broadcasting ``small`` only when it is proven small."""
    side = F.broadcast(small) if is_small(small, max_rows, max_bytes) else small
    return big.join(side, on=on, how=how)
