"""Source-side row filters: blank keys (P1-P3, P11) and equality filters (I4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is blank (or NULL)."""
    cond = None
    for c in cols:
        e = F.coalesce(F.col(c).cast("string") != "", F.lit(False))
        cond = e if cond is None else cond & e
    return df.where(cond)


def product_type_filter(df: DataFrame, col: str, value: str | None) -> DataFrame:
    """Equality filter applied only when a type is set (pushed to the scan)."""
    return df if value in (None, "") else df.where(F.col(col) == value)
