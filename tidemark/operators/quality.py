"""Referential integrity and membership (J12-J16) as semi/anti/equi joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cond(left: DataFrame, right: DataFrame, on: dict):
    c = None
    for lk, rk in on.items():
        e = left[lk] == right[rk]
        c = e if c is None else c & e
    return c


def known(batch: DataFrame, known_set: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key exists in ``known_set`` (``left_semi``)."""
    return batch.join(known_set.select(*keys), on=keys, how="left_semi")


def orphans(child: DataFrame, parent: DataFrame, on: dict) -> DataFrame:
    """Children without a parent (``left_anti``); ``on`` maps child -> parent key."""
    return child.join(parent, on=_cond(child, parent, on), how="left_anti")


def assert_no_orphans(child: DataFrame, parent: DataFrame, on: dict, what: str = "child") -> None:
    """Strict mode for a merge: fail when any child lacks its parent."""
    bad = orphans(child, parent, on).limit(1).collect()
    if bad:
        raise ValueError(f"{what}: orphan row {bad[0].asDict()}")


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, on: dict) -> DataFrame:
    """Children that survive the deletion of ``deleted_parents``."""
    return child.join(deleted_parents, on=_cond(child, deleted_parents, on), how="left_anti")


def rekey(child: DataFrame, key_map: DataFrame, key: str, old: str = "old_key", new: str = "new_key") -> DataFrame:
    """Propagate a parent key update: ``key`` := ``new`` where it equals ``old``.

    ``key_map`` is unique on ``old``; the join is a left equi-join so children
    of unchanged parents pass through.
    """
    m = key_map.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    j = child.join(m, on=child[key] == m["_old"], how="left")
    return j.select(*[F.coalesce(F.col("_new"), F.col(key)).alias(key) if c == key else F.col(c)
                      for c in child.columns])


def with_children(parent: DataFrame, child: DataFrame, on: dict) -> DataFrame:
    """Header <-> items as a flat equi-join."""
    return parent.join(child, on=_cond(parent, child, on), how="inner")


def child_counts(parent: DataFrame, child: DataFrame, on: dict, qty: str) -> DataFrame:
    """Per-parent item count and total quantity; children are pre-aggregated
    on the key (map-side combine) before the join."""
    (pk, ck), = on.items()
    agg = child.groupBy(ck).agg(F.count(F.lit(1)).alias("n_items"), F.sum(qty).alias("_q"))
    j = parent.join(agg, on=parent[pk] == agg[ck], how="left")
    return j.select(F.col(pk), F.coalesce(F.col("n_items"), F.lit(0)).alias("n_items"),
                    F.col("_q").cast("long").alias("total_qty"))
