"""Order-dependent per-group values that stay parallel when one group is huge.

A plain ``Window.partitionBy(group)`` puts every row of a group into one task;
if one branch or product holds a third of all rows that task sorts a third of
the data alone. Here rows are range-partitioned by the group **and** the whole
order, so a large group spreads over many ranges, whatever its leading values:

1. ``repartitionByRange(keys, order)`` (its bounds come from a sample) and a
   Parquet copy with the range number, so that every consumer sees the same
   ranges even if part of the plan is computed again;
2. the window runs per ``(range, group)``, never larger than a range; positions need none, as
   the copy is sorted and has each row's place in its range;
3. only the first group of a range can have begun in an earlier one. What it
   carries over (row count, last row) comes from a table with a few rows per
   range, joined back on ``(range, group)``.

There is one path for all sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import is_small

RANGE = "_range"
#: Ranges up to which the tables with a row or two per range are broadcast.
MOST_RANGES = 100_000


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], ranges: int | None = None,
           place: str | None = None) -> DataFrame:
    """``df`` in ranges of ``(keys, order)``, numbered ascending in ``_range``. With ``place`` ranges
    are sorted and that column tells a row's place in its range, from 0.

    ``ranges`` is their number; without it ``spark.sql.shuffle.partitions`` of them are made,
    which adaptive execution packs to its advisory size."""
    by = [*[F.col(k).asc_nulls_first() for k in keys], *_columns(order)]
    parts = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    if place:  # the low 33 bits count a partition's rows
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        parts = parts.sortWithinPartitions(*by).withColumn(place, row)
    path = scratch_path(df.sparkSession, "ranges")
    parts.withColumn(RANGE, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _few(df: DataFrame, ranges: int | None) -> DataFrame:
    """A table with a row per range, or two: every range has one first group, and a group that
    is first in some range lies in consecutive ranges. Its size needs no look at the data:
    ranges are numbered by the partitions that wrote them."""
    conf = df.sparkSession.conf
    parts = ranges or max(int(conf.get(k, "1") or 1) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    return F.broadcast(df) if parts <= MOST_RANGES else df


def _carried(rows: DataFrame, keys: Sequence[str], value: Column, before: Column, ranges: int | None) -> DataFrame:
    """``(_range, keys, _carry)`` for the groups that begin some range: ``value`` is what each
    ``(range, group)`` hands on and ``before`` reduces it over the group's earlier ranges
    (its window is ordered by range). A few rows per range."""
    firsts = rows.groupBy(RANGE).agg(F.min(F.struct(*[F.col(k) for k in keys])).alias("_k"))
    firsts = firsts.select(*[F.col("_k")[k].alias(k) for k in keys]).distinct()
    same = _null_safe(keys)
    some = rows.alias("l").join(_few(firsts, ranges).alias("r"), on=same, how="left_semi")
    return some.groupBy(RANGE, *keys).agg(value.alias("_value")).select(RANGE, *keys, before.alias("_carry"))


def _null_safe(keys: Sequence[str], *more: str) -> Column:
    cond = F.lit(True)
    for k in [*more, *keys]:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return cond


def _with_carry(rows: DataFrame, carried: DataFrame, keys: Sequence[str], ranges: int | None) -> DataFrame:
    j = rows.alias("l").join(_few(carried, ranges).alias("r"), on=_null_safe(keys, RANGE), how="left")
    return j.select("l.*", "r._carry")


def position_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "pos",
                    ranges: int | None = None) -> DataFrame:
    """0-based ``row_number() - 1`` within ``keys`` under ``order``, which must be total.

    Ranges are written in order with the place of each row, so a row's position is its place less
    that of its group's first row in the range, plus the group's rows in earlier ranges: a row
    per (range, group) joined back, and the rows are neither shuffled nor sorted again."""
    keys = list(keys)
    rows = ranged(df, keys, order, ranges, place="_place")
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy(RANGE, *keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shifts = shifts.select(RANGE, *keys, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_carry"))
    if is_small(shifts):
        shifts = F.broadcast(shifts)
    j = rows.alias("l").join(shifts.alias("r"), on=_null_safe(keys, RANGE), how="left").select("l.*", "r._carry")
    return j.withColumn(out, (F.col("_place") + F.col("_carry")).cast("long")).drop("_place", "_carry", RANGE)


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                  seed: DataFrame | None = None, prefix: str = "prev_", exists_col: str = "has_prev",
                  ranges: int | None = None) -> DataFrame:
    """Add the previous row's ``values`` within ``keys`` (ascending ``order``).

    The first row of a group takes its previous values from ``seed`` (one row
    per key, e.g. the current stored state); seed rows travel with the others, ahead of
    their group. ``exists_col`` tells whether a previous row or seed row exists at all --
    distinct from a NULL value.
    """
    keys, order, values = list(keys), list(order), list(values)
    rows = df.withColumn("_seen", F.lit(1))
    if seed is not None:
        # a seed matters only where its key is observed; the rest would only be sorted along
        seed = seed.select(*keys, *values).join(df.select(*keys).distinct(), on=keys, how="left_semi")
        rows = rows.unionByName(seed.withColumn("_seen", F.lit(0)), allowMissingColumns=True)
    rows = ranged(rows, keys, ["_seen", *order], ranges)
    by = _columns(["_seen", *order])
    state = F.struct(*[F.col(v) for v in values])
    earlier = Window.partitionBy(*keys).orderBy(RANGE)
    carried = _carried(rows, keys, F.max_by(state, F.struct("_seen", *order)), F.lag("_value").over(earlier), ranges)
    rows = rows.withColumn("_lag", F.lag(state).over(Window.partitionBy(RANGE, *keys).orderBy(*by)))
    j = _with_carry(rows, carried, keys, ranges).where("_seen = 1")
    previous = F.coalesce("_lag", "_carry")
    return (j.select("*", *[previous[v].alias(f"{prefix}{v}") for v in values], previous.isNotNull().alias(exists_col))
            .drop("_seen", "_lag", "_carry", RANGE))
