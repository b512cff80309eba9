"""Keyed upserts (J1-J8): newer-wins, overwrite, partial-column and insert-if-absent.

``merge`` is a pure DataFrame -> DataFrame function: the new table version is
``target FULL OUTER JOIN source`` on the natural key with one ``CASE`` per
column. Both sides are unique on the key (dedup the batch first), so the join
has no hot keys whatever the input skew; the shuffle is on the key and AQE may
broadcast a small batch. Persisting the result is the job of the publish step,
which writes a new snapshot instead of overwriting the files being read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .latest import first_by_key, latest_by_key

GUARDS = ("newer", "always", "absent")

_T = "_t_exists"
_S = "_s_exists"


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def update_guard(guard: str, version: str | None) -> Column:
    """Condition under which an existing row takes the source values."""
    s_ex, t_ex = F.col(_S), F.col(_T)
    if guard == "always":
        return s_ex
    if guard == "absent":
        return s_ex & t_ex.isNull()
    if guard == "newer":
        if version is None:
            raise ValueError("guard='newer' needs a version column")
        old, new = F.col(f"t.{version}"), F.col(f"s.{version}")
        return s_ex & (t_ex.isNull() | old.isNull() | F.coalesce(new > old, F.lit(False)))
    raise ValueError(f"guard must be one of {GUARDS}")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], guard: str = "newer",
          version: str | None = None, insert_only: Sequence[str] = (),
          created_col: str | None = None, updated_col: str | None = None,
          run_ts=None, dedup: bool = False, seq: Sequence = (),
          with_action: bool = False) -> DataFrame:
    """Upsert ``source`` into ``target`` on ``keys``; returns the new table.

    guard:
      * ``'newer'``  update iff the stored version is NULL or the new one is
        strictly greater (equal or NULL new versions lose); replays are no-ops.
      * ``'always'`` unconditional overwrite of the non-key columns.
      * ``'absent'`` insert-if-absent (existing rows never change).
    ``insert_only`` columns keep their first written value on update.
    Columns missing from ``source`` keep the stored value (NULL on insert).
    ``created_col``/``updated_col`` are audit columns set from ``run_ts``:
    created once on insert, updated on every accepted write.
    ``dedup=True`` first reduces the batch to one row per key (newest wins for
    'newer'/'always', first occurrence for 'absent') ordered by ``seq``.
    """
    keys = list(keys)
    if dedup:
        if guard == "absent":
            source = first_by_key(source, keys, seq)
        elif version is not None:
            source = latest_by_key(source, keys, version, seq)
        elif not seq:
            raise ValueError("dedup without a version needs seq, else any row of a key could win")
        else:
            source = latest_by_key(source, keys, order=[F.col(s).desc_nulls_last() if isinstance(s, str)
                                                        else s for s in seq])
    audit = {c for c in (created_col, updated_col) if c}
    out_cols = list(target.columns)
    src_cols = set(source.columns)
    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = source.withColumn(_S, F.lit(True)).alias("s")
    j = t.join(s, on=keys, how="full_outer")
    upd = update_guard(guard, version)
    t_ex = F.col(_T).isNotNull()
    exprs = []
    for c in out_cols:
        if c in keys:
            exprs.append(F.col(c))
        elif c == created_col:
            exprs.append(F.when(t_ex, F.col(f"t.{c}")).otherwise(_lit(run_ts)).alias(c))
        elif c == updated_col:
            exprs.append(F.when(upd, _lit(run_ts)).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in insert_only:
            new = F.col(f"s.{c}") if c in src_cols else F.lit(None)
            exprs.append(F.when(t_ex, F.col(f"t.{c}")).otherwise(new).alias(c))
        elif c in src_cols and c not in audit:
            exprs.append(F.when(upd, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            exprs.append(F.col(f"t.{c}").alias(c))
    if with_action:
        exprs.append(F.when(~t_ex, F.lit("insert")).when(upd, F.lit("update"))
                     .otherwise(F.lit("keep")).alias("_action"))
    return j.select(*exprs)


def table_from_source(source: DataFrame, columns: Sequence[str], created_col: str | None = None,
                      updated_col: str | None = None, run_ts=None) -> DataFrame:
    """Shape a first batch as a table (all rows inserted)."""
    exprs = []
    for c in columns:
        if c in (created_col, updated_col):
            exprs.append(_lit(run_ts).alias(c))
        else:
            exprs.append(F.col(c))
    return source.select(*exprs)


#: Columns that rows of a change carry beside the table's: what it does, the place of its
#: change, and which of the columns that some change lacks it has.
OP, SEQ, GIVEN = "_op", "_seq", "_given"
PUT, DROP = "put", "drop"


@dataclass(frozen=True)
class MergeRule:
    """How batches change a table, as data: the arguments of :func:`merge` that stay the same
    from run to run. A rule can be stored beside the table, so that changes are kept as
    they came and :meth:`resolve` tells the rows that merging them one by one would have left.
    """
    keys: tuple[str, ...]
    guard: str = "newer"
    version: str | None = None
    insert_only: tuple[str, ...] = ()
    created_col: str | None = None
    updated_col: str | None = None

    def __post_init__(self):
        if self.guard not in GUARDS:
            raise ValueError(f"guard must be one of {GUARDS}")
        if self.guard == "newer" and self.version is None:
            raise ValueError("guard='newer' needs a version column")

    @classmethod
    def of(cls, stored: dict) -> MergeRule:
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in stored.items()})

    def as_dict(self) -> dict:
        return asdict(self)

    def apply(self, target: DataFrame, source: DataFrame, run_ts) -> DataFrame:
        """The new table, at once."""
        return merge(target, source, self.keys, self.guard, self.version, self.insert_only, self.created_col, self.updated_col, run_ts)

    def change(self, source: DataFrame, columns: Sequence[str], run_ts) -> DataFrame:
        """The rows of a batch (one for each key) as a change to a table of ``columns``."""
        audit = {c for c in (self.created_col, self.updated_col) if c}
        given = [c for c in columns if c in source.columns and c not in audit]
        return source.select(*given, *[_lit(run_ts).alias(c) for c in columns if c in audit], F.lit(PUT).alias(OP))

    def resolve(self, rows: DataFrame, columns: Sequence[str], partial: Sequence[str] = (), within: Sequence[str] = ()) -> DataFrame:
        """The table after all changes in ``rows``: its ``columns``, ``_op``, ``_seq`` (0 for stored
        rows, then the number of the change) and, if some change lacks the columns ``partial``,
        ``_given``: bit k is set where the row has the k-th of them.

        A row that drops its key ends all before it. Of the rest, in order of their changes, the
        first puts the row there, and a later one is accepted if the guard allows. A key has a
        row for each change at most, so no key is large; everything is one shuffle by key and one
        sort. ``within`` are columns that a key tells and by which the rows already lie together:
        they are not shuffled, and the columns come first in the result.
        """
        keys = [*within, *self.keys]
        columns = [*within, *columns]
        order = Window.partitionBy(*keys).orderBy(SEQ)
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        # over the ordered rows, which need no other sort for it
        dropped = F.max(F.when(F.col(OP) == DROP, F.col(SEQ))).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        live = rows.withColumn("_dropped", dropped).where((F.col(OP) == PUT) & (F.col("_dropped").isNull() | (F.col(SEQ) > F.col("_dropped"))))
        first = F.row_number().over(order) == 1
        if self.guard == "newer":
            known = F.max(self.version).over(earlier)
            accepted = first | known.isNull() | F.coalesce(F.col(self.version) > known, F.lit(False))
        else:
            accepted = first if self.guard == "absent" else F.lit(True)
        live = live.withColumn("_accepted", F.when(accepted, F.col(SEQ)))
        once = [c for c in columns if c in self.insert_only or c == self.created_col]
        apart = [c for c in columns if c in partial and c not in once and c not in keys]
        plain = [c for c in columns if c not in once and c not in apart and c not in keys]
        picks = [F.max_by(F.struct(*plain), "_accepted").alias("_new")] if plain else []
        picks += [F.min_by(F.struct(*once), SEQ).alias("_old")] if once else []
        bit = {c: k for k, c in enumerate(partial)}
        picks += [F.max_by(F.struct(c), F.when(F.col(GIVEN).bitwiseAND(F.lit(1 << bit[c])) != 0, F.col("_accepted"))).alias(f"_one_{c}") for c in apart]
        if not picks:
            return live.select(*keys).distinct()
        found = live.groupBy(*keys).agg(*picks)
        place = {**{c: F.col("_new")[c] for c in plain}, **{c: F.col("_old")[c] for c in once}, **{c: F.col(f"_one_{c}")[c] for c in apart}}
        return found.select(*[F.col(c) if c in keys else place[c].alias(c) for c in columns])
