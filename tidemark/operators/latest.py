"""Newest-version-per-key (A1/A2), last value per day (A11) and key checks.

All three are map-side combinable: ``row_number() == 1`` is planned with a
partial ``WindowGroupLimit`` before the exchange and ``max_by`` with a partial
aggregate, so a hot key is reduced to one row per input partition before the
shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _asc(c) -> Column:
    return F.col(c).asc_nulls_first() if isinstance(c, str) else c


def version_order(version, seq: Sequence = ()) -> list[Column]:
    """Sort expressions for "newest wins": version DESC NULLS LAST, then seq.

    ``seq`` items are column names (ascending: earlier row wins a tie) or
    ready-made sort expressions.
    """
    return [_col(version).desc_nulls_last(), *[_asc(s) for s in seq]]


def file_order(version, file_col, row_col) -> list[Column]:
    """Tie rule of sequential file imports.

    Equal non-NULL versions: the earliest file/row wins (later writes are not
    newer). All-NULL versions: inside a file the first row wins, across files
    the last file wins (a NULL stored version is always overwritten).
    """
    v = _col(version)
    f = _col(file_col)
    return [v.desc_nulls_last(),
            F.when(v.isNotNull(), f).asc_nulls_first(),
            F.when(v.isNull(), f).desc_nulls_last(),
            _col(row_col).asc_nulls_first()]


def latest_by_key(df: DataFrame, keys: Sequence[str], version=None, seq: Sequence = (),
                  order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the newest ``version``; NULL loses to non-NULL; ties keep
    the first row by ``seq``. ``order`` overrides the sort expressions."""
    order = list(order) if order is not None else version_order(version, seq)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_by_key(df: DataFrame, keys: Sequence[str], seq: Sequence) -> DataFrame:
    """One row per key: the first occurrence by ``seq`` (insert-if-absent dedup)."""
    w = Window.partitionBy(*keys).orderBy(*[_asc(s) for s in seq])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def last_value_per_day(df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str],
                       seq: Sequence[str] = (), day_col: str = "stock_date") -> DataFrame:
    """Last value of each ``values`` column per (keys, calendar day of ``ts``).

    Equivalent of ``(ARRAY_AGG(v ORDER BY ts DESC))[1]`` grouped by day; a NULL
    value at the latest time is kept. ``seq`` breaks ties on equal ``ts``
    (later seq wins). With no ``seq`` the ordering is a plain timestamp and the
    aggregate stays hash-based.
    """
    ordering = F.struct(F.col(ts), *[F.col(s) for s in seq]) if seq else F.col(ts)
    return (df.groupBy(*keys, F.to_date(F.col(ts)).alias(day_col))
              .agg(*[F.max_by(F.col(v), ordering).alias(v) for v in values]))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys named more than once (partial-aggregated count)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "batch") -> None:
    """Strict mode: fail when a batch names a key twice."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"{what}: key {dup[0].asDict()} occurs more than once")
