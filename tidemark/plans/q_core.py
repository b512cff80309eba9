"""Core operators over the driver tables: latest-per-key, merges, HWM, windows,
integrity checks. Each query has a DuckDB oracle with identical column names."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import iso_millis_utc
from ..operators import latest as L
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import watermarks as H
from ..session import ntz
from .registry import register
from .sqlgen import date_lit, latest_sql, merge_sql, order_sql
from .tables import (EV_COLS, EV_EARLY, EV_KNOWN, EV_NOW, LI_COLS, LI_KEY, LI_SPLIT, LI_TIEBREAK,
                     LI_VERSION, RUN_1, RUN_2, RUN_3, table)

# ---------------------------------------------------------------- A11 flagship
DAILY_SQL = """
SELECT user_id, stock_date, value, event_type FROM (
  SELECT user_id, CAST(ts AS DATE) AS stock_date, value, event_type,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn__
  FROM events) x WHERE rn__ = 1
"""


@register("daily_last_value", DAILY_SQL)
def daily_last_value(spark, sf):
    """Last observed value per (user, day) -- the daily stock-level view shape."""
    ev = table(spark, sf, "events")
    return L.last_value_per_day(ev, ["user_id"], "ts", ["value", "event_type"], seq=["event_id"])


# ---------------------------------------------------------------- A1 / A2
HEADER_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_returnflag", "l_linestatus", "l_shipdate"]
_HEADER_SEQ = ["l_linenumber"] + LI_TIEBREAK


@register("latest_header", latest_sql("lineitem", ["l_orderkey"], order_sql(LI_VERSION, _HEADER_SEQ), HEADER_COLS))
def latest_header(spark, sf):
    li = table(spark, sf, "lineitem")
    return L.latest_by_key(li, ["l_orderkey"], LI_VERSION, _HEADER_SEQ).select(*HEADER_COLS)


@register("latest_client", latest_sql("events", ["user_id"], order_sql("ts", ["event_id"]), EV_COLS))
def latest_client(spark, sf):
    ev = table(spark, sf, "events")
    return L.latest_by_key(ev, ["user_id"], "ts", ["event_id"]).select(*EV_COLS)


# ---------------------------------------------------------------- J1-J3, T9, T10
ITEM_TABLE_COLS = LI_COLS + ["created_at", "updated_at"]
_LI_ORDER = order_sql(LI_VERSION, LI_TIEBREAK)


def _items_target(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col(LI_VERSION) < ntz(LI_SPLIT))
    latest = L.latest_by_key(li, LI_KEY, LI_VERSION, LI_TIEBREAK)
    return M.table_from_source(latest, ITEM_TABLE_COLS, "created_at", "updated_at", RUN_1)


def _items_source(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col(LI_VERSION) >= ntz(LI_SPLIT))
    return L.latest_by_key(li, LI_KEY, LI_VERSION, LI_TIEBREAK)


_T_ITEMS = (f"(SELECT *, {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at FROM ("
            + latest_sql(f"(SELECT * FROM lineitem WHERE {LI_VERSION} < TIMESTAMP '{LI_SPLIT}')", LI_KEY,
                         _LI_ORDER, LI_COLS) + ") a)")
_S_ITEMS = ("(" + latest_sql(f"(SELECT * FROM lineitem WHERE {LI_VERSION} >= TIMESTAMP '{LI_SPLIT}')",
                             LI_KEY, _LI_ORDER, LI_COLS) + ")")
MERGE_NEWER_SQL = merge_sql(_T_ITEMS, _S_ITEMS, LI_KEY, ITEM_TABLE_COLS, "newer", LI_VERSION,
                            created="created_at", updated="updated_at", run_ts=date_lit(RUN_2))


@register("merge_newer_wins", MERGE_NEWER_SQL)
def merge_newer_wins(spark, sf):
    return M.merge(_items_target(spark, sf), _items_source(spark, sf), LI_KEY, "newer", LI_VERSION,
                   created_col="created_at", updated_col="updated_at", run_ts=RUN_2)


PARTIAL_INSERT_ONLY = ["l_partkey", "l_suppkey"]


_S_ITEMS_P = "(SELECT * REPLACE (l_partkey + 1 AS l_partkey) FROM " + _S_ITEMS + " b)"


@register("merge_partial", merge_sql(_T_ITEMS, _S_ITEMS_P, LI_KEY, ITEM_TABLE_COLS, "newer", LI_VERSION,
                                     insert_only=PARTIAL_INSERT_ONLY, created="created_at",
                                     updated="updated_at", run_ts=date_lit(RUN_2)))
def merge_partial(spark, sf):
    src = _items_source(spark, sf).withColumn("l_partkey", F.col("l_partkey") + 1)
    return M.merge(_items_target(spark, sf), src, LI_KEY, "newer", LI_VERSION,
                   insert_only=PARTIAL_INSERT_ONLY, created_col="created_at", updated_col="updated_at",
                   run_ts=RUN_2)


@register("replay_idempotent", MERGE_NEWER_SQL)
def replay_idempotent(spark, sf):
    once = merge_newer_wins(spark, sf)
    return M.merge(once, _items_source(spark, sf), LI_KEY, "newer", LI_VERSION,
                   created_col="created_at", updated_col="updated_at", run_ts=RUN_3)


_T_ALL = (f"(SELECT *, {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at FROM ("
          + latest_sql("lineitem", LI_KEY, _LI_ORDER, LI_COLS) + ") a)")


@register("late_data_dropped", f"SELECT {', '.join(ITEM_TABLE_COLS)} FROM {_T_ALL} z")
def late_data_dropped(spark, sf):
    """Older (or equal) versions arriving late never replace the stored row."""
    li = table(spark, sf, "lineitem")
    target = M.table_from_source(L.latest_by_key(li, LI_KEY, LI_VERSION, LI_TIEBREAK), ITEM_TABLE_COLS,
                                 "created_at", "updated_at", RUN_1)
    stored = target.select(*LI_KEY, F.col(LI_VERSION).alias("_stored"))
    late = (li.join(stored, on=LI_KEY, how="inner").where(F.col(LI_VERSION) < F.col("_stored")).drop("_stored")
              .withColumn("l_quantity", F.col("l_quantity") + 1000))
    return M.merge(target, late, LI_KEY, "newer", LI_VERSION, created_col="created_at",
                   updated_col="updated_at", run_ts=RUN_2, dedup=True, seq=LI_TIEBREAK)


# ---------------------------------------------------------------- J4-J7 overwrite
SUP_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal", "created_at", "updated_at"]
_T_SUP = (f"(SELECT s_suppkey, s_name, s_nationkey, s_acctbal, {date_lit(RUN_1)} AS created_at, "
          f"{date_lit(RUN_1)} AS updated_at FROM supplier WHERE s_nationkey < 20)")
_S_SUP = ("(SELECT s_suppkey, s_name || '*' AS s_name, s_nationkey, s_acctbal + 100.0 AS s_acctbal "
          "FROM supplier WHERE s_nationkey >= 10)")


@register("merge_overwrite", merge_sql(_T_SUP, _S_SUP, ["s_suppkey"], SUP_COLS, "always",
                                       created="created_at", updated="updated_at", run_ts=date_lit(RUN_2)))
def merge_overwrite(spark, sf):
    sup = table(spark, sf, "supplier")
    target = M.table_from_source(sup.where(F.col("s_nationkey") < 20), SUP_COLS, "created_at", "updated_at", RUN_1)
    src = sup.where(F.col("s_nationkey") >= 10).select(
        "s_suppkey", F.concat(F.col("s_name"), F.lit("*")).alias("s_name"), "s_nationkey",
        (F.col("s_acctbal") + 100.0).alias("s_acctbal"))
    return M.merge(target, src, ["s_suppkey"], "always", created_col="created_at", updated_col="updated_at",
                   run_ts=RUN_2)


# ---------------------------------------------------------------- J8 insert-if-absent
RV_KEY = ["user_id", "event_type"]
RV_COLS = ["user_id", "event_type", "event_id", "ts", "value", "created_at"]
_RV_FIRST = order_sql(None, ["ts", "event_id"])
_T_RV = (f"(SELECT *, {date_lit(RUN_1)} AS created_at FROM ("
         + latest_sql(f"(SELECT * FROM events WHERE ts < TIMESTAMP '{EV_EARLY}')", RV_KEY, _RV_FIRST,
                      ["user_id", "event_type", "event_id", "ts", "value"]) + ") a)")
_S_RV = ("(" + latest_sql("(SELECT event_id, ts, user_id, event_type, value + 1 AS value FROM events)", RV_KEY,
                          _RV_FIRST, ["user_id", "event_type", "event_id", "ts", "value"]) + ")")


@register("insert_if_absent", merge_sql(_T_RV, _S_RV, RV_KEY, RV_COLS, "absent", created="created_at",
                                        run_ts=date_lit(RUN_2)))
def insert_if_absent(spark, sf):
    ev = table(spark, sf, "events")
    first = L.first_by_key(ev.where(F.col("ts") < ntz(EV_EARLY)), RV_KEY, ["ts", "event_id"])
    target = M.table_from_source(first, RV_COLS, "created_at", None, RUN_1)
    src = ev.select("event_id", "ts", "user_id", "event_type", (F.col("value") + 1).alias("value"))
    return M.merge(target, src, RV_KEY, "absent", created_col="created_at", run_ts=RUN_2, dedup=True,
                   seq=["ts", "event_id"])


# ---------------------------------------------------------------- A3/A4/J9/F15/F16 HWM
@register("hwm_by_branch", """
SELECT 'transactions_csv' AS entity, CAST(l_suppkey AS VARCHAR) AS branch_id, max(l_shipdate) AS last_updated
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY l_suppkey""")
def hwm_by_branch(spark, sf):
    return H.seed_hwm(table(spark, sf, "lineitem"), "transactions_csv", LI_VERSION, branch="l_suppkey")


@register("hwm_global", """
SELECT 'clients_csv' AS entity, 'ALL' AS branch_id, max(ts) AS last_updated FROM events WHERE ts IS NOT NULL""")
def hwm_global(spark, sf):
    return H.seed_hwm(table(spark, sf, "events"), "clients_csv", "ts")


_HWM_OLD_SQL = f"""
SELECT 'transactions_csv' AS entity, CAST(l_suppkey AS VARCHAR) AS branch_id, max(l_shipdate) AS last_updated,
       {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at
FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey"""
_HWM_CAND_SQL = """
SELECT 'transactions_csv' AS entity, CAST(l_suppkey AS VARCHAR) AS branch_id, max(l_shipdate) AS cand
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_suppkey
UNION ALL SELECT 'transactions_csv', 'ALL', max(l_shipdate) FROM lineitem WHERE l_returnflag <> 'R'"""
HWM_MERGE_SQL = f"""
SELECT COALESCE(o.entity, c.entity) AS entity, COALESCE(o.branch_id, c.branch_id) AS branch_id,
       greatest(o.last_updated, c.cand) AS last_updated,
       COALESCE(o.created_at, {date_lit(RUN_2)}) AS created_at,
       CASE WHEN c.cand IS NOT NULL THEN {date_lit(RUN_2)} ELSE o.updated_at END AS updated_at
FROM ({_HWM_OLD_SQL}) o FULL OUTER JOIN ({_HWM_CAND_SQL}) c
  ON o.entity = c.entity AND o.branch_id = c.branch_id"""


@register("hwm_merge", HWM_MERGE_SQL)
def hwm_merge(spark, sf):
    li = table(spark, sf, "lineitem")
    old = H.seed_hwm(li.where(F.col("l_returnflag") == "R"), "transactions_csv", LI_VERSION, branch="l_suppkey")
    old = old.withColumn("created_at", F.lit(RUN_1)).withColumn("updated_at", F.lit(RUN_1))
    rest = li.where(F.col("l_returnflag") != "R")
    cand = H.seed_hwm(rest, "transactions_csv", LI_VERSION, branch="l_suppkey").unionByName(
        # entity-wide candidate arrives with a blank branch id and lands on 'ALL'
        rest.agg(F.max(LI_VERSION).alias("last_updated"))
            .select(F.lit("transactions_csv").alias("entity"), F.lit("").alias("branch_id"), "last_updated"))
    return H.merge_hwm(old, cand, RUN_2)


# ---------------------------------------------------------------- I1-I4
_EV_HWM_SQL = (f"(SELECT 'reviews_api' AS entity, event_type AS branch_id, max(ts) AS last_updated FROM events "
               f"WHERE ts < TIMESTAMP '{EV_EARLY}' AND event_type <> 'signup' GROUP BY event_type)")


def _events_hwm(ev):
    early = ev.where((F.col("ts") < ntz(EV_EARLY)) & (F.col("event_type") != "signup"))
    return H.seed_hwm(early, "reviews_api", "ts", branch="event_type")


@register("incremental_window", f"""
SELECT e.event_id, e.event_type, e.ts,
       strftime(date_trunc('day', COALESCE(h.last_updated, TIMESTAMP '2000-01-01 00:00:00')), '%Y-%m-%dT%H:%M:%S.%gZ') AS since_text,
       strftime(TIMESTAMP '{EV_NOW[:10]} 23:59:59.999', '%Y-%m-%dT%H:%M:%S.%gZ') AS until_text
FROM events e LEFT JOIN {_EV_HWM_SQL} h ON e.event_type = h.branch_id
WHERE e.ts BETWEEN date_trunc('day', COALESCE(h.last_updated, TIMESTAMP '2000-01-01 00:00:00'))
              AND TIMESTAMP '{EV_NOW[:10]} 23:59:59.999'""")
def incremental_window(spark, sf):
    ev = table(spark, sf, "events")
    out = H.incremental_window(ev, _events_hwm(ev), "ts", "day_window", now=ntz(EV_NOW), on="event_type",
                               since_col="_since", until_col="_until")
    return out.select("event_id", "event_type", "ts", iso_millis_utc("_since").alias("since_text"),
                      iso_millis_utc("_until").alias("until_text"))


@register("window_both_bounds", f"""
SELECT e.event_id, e.event_type, e.ts, e.value FROM events e LEFT JOIN {_EV_HWM_SQL} h ON e.event_type = h.branch_id
WHERE h.last_updated IS NULL OR (e.ts > h.last_updated AND e.ts <= TIMESTAMP '{EV_NOW}')""")
def window_both_bounds(spark, sf):
    ev = table(spark, sf, "events")
    out = H.incremental_window(ev, _events_hwm(ev), "ts", "between", now=ntz(EV_NOW), on="event_type")
    return out.select("event_id", "event_type", "ts", "value")


@register("clients_after_hwm", f"""
SELECT event_id, user_id, ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{EV_EARLY}')""")
def clients_after_hwm(spark, sf):
    ev = table(spark, sf, "events")
    hwm = H.seed_hwm(ev.where(F.col("ts") < ntz(EV_EARLY)), "clients_csv", "ts")
    return H.incremental_window(ev, hwm, "ts", "after", entity="clients_csv").select("event_id", "user_id", "ts")


@register("type_filter", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'click'")
def type_filter(spark, sf):
    from ..operators.filters import product_type_filter
    ev = table(spark, sf, "events")
    return product_type_filter(ev, "event_type", "click").select("event_id", "ts", "user_id", "event_type", "value")


# ---------------------------------------------------------------- J12, A8/F21, W3
@register("known_in_set", f"""
SELECT b.event_type, b.event_id FROM events b
WHERE b.ts >= TIMESTAMP '{EV_EARLY}' AND EXISTS (
  SELECT 1 FROM events k WHERE k.ts < TIMESTAMP '{EV_KNOWN}' AND k.event_type = b.event_type AND k.event_id = b.event_id)""")
def known_in_set(spark, sf):
    ev = table(spark, sf, "events")
    batch = ev.where(F.col("ts") >= ntz(EV_EARLY)).select("event_type", "event_id")
    known = ev.where(F.col("ts") < ntz(EV_KNOWN)).select("event_type", "event_id")
    return Q.known(batch, known, ["event_type", "event_id"])


@register("max_date_text", """
SELECT event_type AS branch_id, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS max_review_date FROM events GROUP BY event_type""")
def max_date_text(spark, sf):
    from ..operators.pages import max_date_by_branch
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "branch_id")
    return max_date_by_branch(ev.withColumn("review_date", F.to_date("ts")), "branch_id", "review_date")


@register("latest_n", """
SELECT event_type, event_id, ts, rank_no FROM (
  SELECT event_type, event_id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rank_no
  FROM events) x WHERE rank_no <= 10""")
def latest_n(spark, sf):
    from ..operators.pages import latest_n as top
    ev = table(spark, sf, "events")
    return top(ev, ["event_type"], [F.col("ts").desc(), F.col("event_id").desc()], n=10,
               rank_col="rank_no").select("event_type", "event_id", "ts", "rank_no")


# ---------------------------------------------------------------- J13-J16
@register("dup_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
                      "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def dup_keys(spark, sf):
    return L.duplicate_keys(table(spark, sf, "lineitem"), LI_KEY)


_PARENT_CUT = "1996-01-01 00:00:00"


@register("orphans", f"""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderdate >= TIMESTAMP '{_PARENT_CUT}')""")
def orphans(spark, sf):
    parents = table(spark, sf, "orders").where(F.col("o_orderdate") >= ntz(_PARENT_CUT))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return Q.orphans(li, parents, {"l_orderkey": "o_orderkey"})


@register("cascade_delete", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')""")
def cascade_delete(spark, sf):
    deleted = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return Q.cascade_delete(li, deleted, {"l_orderkey": "o_orderkey"})


@register("cascade_rekey", """
SELECT COALESCE(CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderkey + 100000000 END, l.l_orderkey) AS l_orderkey,
       l.l_linenumber, l.l_quantity
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def cascade_rekey(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    key_map = o.select(F.col("o_orderkey").alias("old_key"), (F.col("o_orderkey") + 100000000).alias("new_key"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return Q.rekey(li, key_map, "l_orderkey")


@register("header_with_items", """
SELECT o.o_orderkey, o.o_orderdate, o.o_orderstatus, l.l_linenumber, l.l_quantity, l.l_shipdate
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def header_with_items(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return Q.with_children(o, li, {"o_orderkey": "l_orderkey"}).drop("l_orderkey")


@register("header_item_counts", """
SELECT o.o_orderkey, count(l.l_orderkey) AS n_items, CAST(sum(l.l_quantity) AS BIGINT) AS total_qty
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey""")
def header_item_counts(spark, sf):
    """Nested form of J15 reduced to per-header counts (children aggregated
    before the join, so no header ever gathers its items in one task)."""
    o = table(spark, sf, "orders").select("o_orderkey")
    li = table(spark, sf, "lineitem")
    return Q.child_counts(o, li, {"o_orderkey": "l_orderkey"}, "l_quantity")


# ---------------------------------------------------------------- J3 + sequential tie rule inside one batch
_FIRST_COLS = ["l_partkey", "l_suppkey"]


@register("items_first_seen", f"""
WITH newest AS ({latest_sql("lineitem", LI_KEY, _LI_ORDER, LI_COLS)}),
first AS ({latest_sql("lineitem", LI_KEY, order_sql(None, ["l_shipdate"] + LI_TIEBREAK), LI_KEY + _FIRST_COLS)})
SELECT n.l_orderkey, f.l_partkey, f.l_suppkey, n.l_linenumber, n.l_quantity, n.l_extendedprice, n.l_discount,
       n.l_tax, n.l_returnflag, n.l_linestatus, n.l_shipdate
FROM newest n JOIN first f ON f.l_orderkey = n.l_orderkey AND f.l_linenumber = n.l_linenumber""")
def items_first_seen(spark, sf):
    """A batch naming an item several times, read in ship-date order: the
    newest version's values, but insert-only columns from the first row."""
    from .jobs import newest_with_first_seen
    li = table(spark, sf, "lineitem")
    out = newest_with_first_seen(li, LI_KEY, L.version_order(LI_VERSION, LI_TIEBREAK), ["l_shipdate"] + LI_TIEBREAK,
                                 _FIRST_COLS)
    return out.select(*LI_COLS)
