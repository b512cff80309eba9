"""Append-only change history (W1, U3) and current-state derivation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import with_previous

HISTORY_SOURCE = "sync"


def change_history(obs: DataFrame, current: DataFrame | None, keys: Sequence[str], value: str,
                   seq: Sequence[str], carry: Sequence[str] = (), time_col: str | None = None,
                   run_ts=None, source: str = HISTORY_SOURCE, ranges: int | None = None) -> DataFrame:
    """History rows for a batch of observations.

    A row is emitted for an observation when its key has no earlier state at
    all (first sight) or when ``value`` differs null-safely from the previous
    state; changes in ``carry`` columns alone (price) emit nothing, but the
    emitted row carries their new values. The previous state of a key's first
    observation is its row in ``current`` (one row per key), later ones see
    the preceding observation in ``seq`` order.
    """
    keys = list(keys)
    seed = None if current is None else current.select(*keys, value)
    # the ordered copy holds what it is read for, not the feed's other columns
    snap = F.col(time_col) if time_col else F.lit(run_ts)
    obs = obs.select(*dict.fromkeys([*keys, *seq, value, *carry]), snap.alias("_snap"))
    d = with_previous(obs, keys, seq, [value], seed=seed, ranges=ranges)
    changed = ~F.col("has_prev") | ~F.col(value).eqNullSafe(F.col(f"prev_{value}"))
    return d.where(changed).select(*keys, F.col("_snap").alias("snapshot_time"), F.col(value), *carry,
                                   F.lit(source).alias("source"))


def replay_state(history: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Current value per key reconstructed from the history (last row wins)."""
    o = F.struct(*[F.col(c) for c in order])
    return history.groupBy(*keys).agg(F.max_by(F.col(value), o).alias(value))


#: The state's column that holds each value's place in the order, so that states can be merged.
STATE_ORDER = "last_seen"


def daily_state(rows: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], seq: Sequence[str] = (),
                day_col: str = "stock_date") -> DataFrame:
    """Last ``values`` per (keys, day of ``ts``) together with where they stand: ``(ts, seq)``."""
    last = F.struct(F.col(ts).alias("at"), *[F.col(s).alias(f"seq{k}") for k, s in enumerate(seq)])
    state = rows.select(*keys, F.to_date(ts).alias(day_col), *values, last.alias(STATE_ORDER))
    return merge_states(state, keys, values, day_col)


def merge_states(states: DataFrame, keys: Sequence[str], values: Sequence[str], day_col: str = "stock_date") -> DataFrame:
    """One row per (keys, day) of several states: the one that stands last. A row of new history
    and the stored state of its day merge alike, whatever order the runs come in."""
    found = states.groupBy(*keys, day_col).agg(F.max_by(F.struct(*values), STATE_ORDER).alias("_v"), F.max(STATE_ORDER).alias(STATE_ORDER))
    return found.select(*keys, day_col, *[F.col("_v")[v].alias(v) for v in values], STATE_ORDER)


def register_daily_view(spark, history: DataFrame, name: str = "daily_stock_levels",
                        keys: Sequence[str] = ("branch_id", "product_id"), ts: str = "snapshot_time",
                        values: Sequence[str] = ("quantity_in_stock", "price"),
                        seq: Sequence[str] = ()) -> DataFrame:
    """The daily last-value view (K4) over the history, as a temp view. ``seq`` orders rows
    with one time, such as several changes of a product in one run."""
    from .latest import last_value_per_day
    view = last_value_per_day(history, list(keys), ts, list(values), seq=list(seq))
    view.createOrReplaceTempView(name)
    return view
