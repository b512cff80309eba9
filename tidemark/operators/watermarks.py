"""High-water marks (HWM): seed, monotone merge, lookup and incremental windows.

A HWM table has one row per ``(entity, branch_id)``:
``entity, branch_id, last_updated, created_at, updated_at``. Entity-wide
marks use the branch id ``'ALL'``. The table is tiny (one row per entity and
branch) but it is still joined, never collected, so Spark picks broadcast or
shuffle from its measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import GLOBAL_BRANCH, global_branch
from .joins import join_small

HWM_COLUMNS = ["entity", "branch_id", "last_updated", "created_at", "updated_at"]
# Start of the incremental window when a branch has no mark yet.
DEFAULT_SINCE = "2000-01-01 00:00:00"


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def seed_hwm(df: DataFrame, entity: str, version: str, branch: str | None = None) -> DataFrame:
    """Candidate marks from loaded data: ``MAX(version)`` per branch, or one
    entity-wide mark (branch ``'ALL'``) when ``branch`` is None. NULL versions
    are ignored; a branch with none gets no row."""
    d = df.where(F.col(version).isNotNull())
    if branch is None:
        out = d.agg(F.max(version).alias("last_updated")).where(F.col("last_updated").isNotNull())
        out = out.select(F.lit(entity).alias("entity"), F.lit(GLOBAL_BRANCH).alias("branch_id"), "last_updated")
    else:
        out = (d.groupBy(global_branch(F.col(branch).cast("string")).alias("branch_id"))
                .agg(F.max(version).alias("last_updated"))
                .select(F.lit(entity).alias("entity"), "branch_id", "last_updated"))
    return out


def empty_hwm(spark, ts_type: str = "timestamp", audit_type: str = "timestamp") -> DataFrame:
    return spark.createDataFrame([], f"entity string, branch_id string, last_updated {ts_type}, "
                                     f"created_at {audit_type}, updated_at {audit_type}")


def merge_hwm(hwm: DataFrame, candidates: DataFrame, run_ts) -> DataFrame:
    """Monotone upsert: ``last_updated = GREATEST(old, new)``.

    Candidates are ``(entity, branch_id, last_updated)``; blank branch ids
    become ``'ALL'``, NULL candidates are ignored. ``created_at`` is set once,
    ``updated_at`` moves on every upsert that had a candidate. Stored marks and
    candidates are unioned and reduced by one ``groupBy(entity, branch_id)``
    (map-side combined), so any number of candidates per key collapses to its
    maximum without a join.
    """
    types = {f.name: f.dataType for f in hwm.schema.fields}
    old = hwm.select(*HWM_COLUMNS, F.lit(False).alias("_cand"))
    cand = (candidates.where(F.col("last_updated").isNotNull())
            .select("entity", global_branch("branch_id").alias("branch_id"),
                    F.col("last_updated").cast(types["last_updated"]).alias("last_updated"),
                    F.lit(None).cast(types["created_at"]).alias("created_at"),
                    F.lit(None).cast(types["updated_at"]).alias("updated_at"),
                    F.lit(True).alias("_cand")))
    g = (old.unionByName(cand).groupBy("entity", "branch_id")
            .agg(F.max("last_updated").alias("last_updated"), F.min("created_at").alias("created_at"),
                 F.max("updated_at").alias("_old_updated"), F.max("_cand").alias("_has_cand")))
    return g.select(
        "entity", "branch_id", "last_updated",
        F.coalesce(F.col("created_at"), _lit(run_ts).cast(types["created_at"])).alias("created_at"),
        F.when(F.col("_has_cand"), _lit(run_ts).cast(types["updated_at"])).otherwise(F.col("_old_updated"))
         .alias("updated_at"),
    )


def get_hwm(hwm: DataFrame, entity: str, branch: str | None = None) -> DataFrame:
    """Lookup by ``(entity, branch)``; zero rows when missing."""
    b = GLOBAL_BRANCH if branch in (None, "") else branch
    return hwm.where((F.col("entity") == entity) & (F.col("branch_id") == b))


def upgrade_hwm(old: DataFrame) -> DataFrame:
    """Old layout ``(source_name, branch_id, last_updated_at, ...)`` -> current.

    ``source_name`` becomes ``entity``, ``last_updated_at`` becomes
    ``last_updated``, blank/NULL branch becomes ``'ALL'``; old columns drop.
    """
    cols = set(old.columns)
    entity = F.coalesce(F.col("entity"), F.col("source_name")) if "entity" in cols else F.col("source_name")
    last = (F.coalesce(F.col("last_updated"), F.col("last_updated_at")) if "last_updated" in cols
            else F.col("last_updated_at"))
    return old.select(entity.alias("entity"), global_branch("branch_id").alias("branch_id"),
                      last.alias("last_updated"), "created_at", "updated_at")


def needs_bootstrap(hwm: DataFrame, entities: Sequence[str]) -> bool:
    """True when none of ``entities`` has a mark yet (bounded: ``limit(1)``)."""
    return len(hwm.where(F.col("entity").isin(list(entities))).limit(1).collect()) == 0


def is_empty(df: DataFrame) -> bool:
    return len(df.limit(1).collect()) == 0


def end_of_day(now: Column) -> Column:
    """``now``'s calendar day at 23:59:59.999."""
    return F.date_trunc("day", now) + F.expr("INTERVAL '23:59:59.999' HOUR TO SECOND")


def incremental_window(df: DataFrame, hwm: DataFrame, ts_col: str, mode: str,
                       now=None, on: str | None = None, entity: str | None = None,
                       since_col: str | None = None, until_col: str | None = None,
                       inclusive: bool = False, keep_null: bool = False) -> DataFrame:
    """Restrict a source to what is newer than its HWM. ``keep_null`` also keeps rows
    without a version: for feeds whose source applied the window itself, every exported
    row counts (a merge still never lets them replace a newer one).

    mode:
      * ``'after'``      ``ts > hwm`` (``>=`` with ``inclusive=True``, for
        date-only versions where new keys can share the mark's day); no mark
        -> everything (clients).
      * ``'day_window'`` ``[day(hwm or 2000-01-01) 00:00, day(now) 23:59:59.999]``
        closed, deliberately re-reading the mark's whole day (transactions).
      * ``'between'``    ``hwm < ts <= now``, applied only when both bounds
        exist; otherwise no filter (products).
    ``on`` names the source column holding the branch id (per-branch marks,
    one row per branch, broadcast behind a bounded size check). When None
    the entity-wide mark (``'ALL'``, a single value) applies as a literal
    bound that reaches the Parquet scan.
    """
    marks = hwm if entity is None else hwm.where(F.col("entity") == entity)
    if on is None:
        # exactly one value: fetched once and used as a literal, so the bound is
        # pushed into the scan (row groups older than the mark are skipped)
        value = marks.where(F.col("branch_id") == GLOBAL_BRANCH).agg(F.max("last_updated")).collect()[0][0]
        j = df.withColumn("_hwm", F.lit(value).cast(hwm.schema["last_updated"].dataType))
    else:
        mark = marks.select(F.col("branch_id").alias("_hwm_branch"), F.col("last_updated").alias("_hwm"))
        # one row per branch: broadcast after a bounded size check, so a hot
        # branch in the source is never shuffled into a single partition
        j = (join_small(df.withColumn("_hwm_key", F.col(on).cast("string")), mark,
                        on=F.col("_hwm_key") == F.col("_hwm_branch"), how="left")
               .drop("_hwm_key", "_hwm_branch"))
    ts_type = df.schema[ts_col].dataType
    hwm_c = F.col("_hwm").cast(ts_type)
    ts = F.col(ts_col)
    now_c = None if now is None else _lit(now).cast(ts_type)
    until = None
    unknown = ts.isNull() if keep_null else F.lit(False)
    if mode == "after":
        out = j.where(hwm_c.isNull() | ((ts >= hwm_c) if inclusive else (ts > hwm_c)) | unknown)
        since = hwm_c
    elif mode == "day_window":
        if now_c is None:
            raise ValueError("day_window needs now")
        since = F.date_trunc("day", F.coalesce(hwm_c, F.lit(DEFAULT_SINCE).cast(ts_type))).cast(ts_type)
        until = end_of_day(now_c).cast(ts_type)
        out = j.where(ts.between(since, until) | unknown)
    elif mode == "between":
        since, until = hwm_c, now_c
        out = j if now_c is None else j.where(hwm_c.isNull() | ((ts > hwm_c) & (ts <= now_c)) | unknown)
    else:
        raise ValueError("mode must be 'after', 'day_window' or 'between'")
    if since_col:
        out = out.withColumn(since_col, since)
    if until_col:
        out = out.withColumn(until_col, until if until is not None else F.lit(None).cast(ts_type))
    return out.drop("_hwm")


#: Partition columns of staged rows.
STAGE_BRANCH, STAGE_DAY = "stage_branch", "stage_day"
_NONE = "__none__"


def stage_by_day(df: DataFrame, path: str, ts_col: str, on: str) -> None:
    """Write landed rows by branch and day of ``ts_col`` (rows without one apart), so that an
    incremental window opens only the days it can hold."""
    staged = df.withColumn(STAGE_BRANCH, F.coalesce(F.col(on).cast("string"), F.lit(_NONE))).withColumn(
        STAGE_DAY, F.coalesce(F.date_format(ts_col, "yyyy-MM-dd"), F.lit(_NONE)))
    staged.hint("rebalance", STAGE_BRANCH, STAGE_DAY).write.mode("append").partitionBy(STAGE_BRANCH, STAGE_DAY).parquet(path)


def staged_window(spark, path: str, hwm: DataFrame, ts_col: str, mode: str, now=None, on: str = "branch_id",
                  entity: str | None = None, keep_null: bool = False, inclusive: bool = False) -> DataFrame:
    """:func:`incremental_window` over rows that :func:`stage_by_day` wrote.

    The marks become a filter on the partitions, one row per branch and day that the window can
    hold, and a semi-join on the partition columns prunes the scan while it runs (dynamic partition
    pruning): days before a branch's mark are not opened. The window itself decides on the rows
    of the days that are left. The days of a mark and of ``now`` are always among them.
    """
    from ..sources.files import folders
    listed = [(b.split("=", 1)[1], d.split("=", 1)[1]) for b, full, _ in folders(spark, path) if b.startswith(STAGE_BRANCH)
              for d, _, _ in folders(spark, full) if d.startswith(STAGE_DAY)]
    types = f"{STAGE_BRANCH} string, {STAGE_DAY} string"
    rows = spark.read.parquet(path) if not listed else spark.read.schema(
        spark.read.parquet(f"{path}").drop(STAGE_BRANCH, STAGE_DAY).schema.add(STAGE_BRANCH, "string").add(STAGE_DAY, "string")).parquet(path)
    parts = spark.createDataFrame([(unescape(b), d) for b, d in listed], types)
    marks = hwm if entity is None else hwm.where(F.col("entity") == entity)
    since = marks.groupBy(F.col("branch_id").alias("_b")).agg(F.date_format(F.max("last_updated"), "yyyy-MM-dd").alias("_since"))
    found = parts.join(F.broadcast(since) if len(listed) < 100_000 else since, F.col(STAGE_BRANCH) == F.col("_b"), "left")
    in_time = F.col("_since").isNull() | (F.col(STAGE_DAY) >= F.col("_since"))
    if now is not None:
        # a window with an upper bound; 'between' has one only for branches with a mark
        last = F.date_format(_lit(now), "yyyy-MM-dd")
        in_time = in_time & ((F.col(STAGE_DAY) <= last) if mode == "day_window" else (F.col("_since").isNull() | (F.col(STAGE_DAY) <= last)))
    elif mode == "between":
        in_time = F.lit(True)
    wanted = found.where(in_time | (F.col(STAGE_DAY) == _NONE)).select(STAGE_BRANCH, STAGE_DAY)
    # a row per branch and day, as many as were listed
    some = rows.join(F.broadcast(wanted) if len(listed) <= 1_000_000 else wanted, [STAGE_BRANCH, STAGE_DAY], "left_semi")
    return incremental_window(some.drop(STAGE_BRANCH, STAGE_DAY), hwm, ts_col, mode, now, on, entity, keep_null=keep_null, inclusive=inclusive)


def unescape(name: str) -> str:
    """A partition value as it was before Spark wrote it into a folder's name."""
    from urllib.parse import unquote
    return unquote(name)
