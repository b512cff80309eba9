"""Flows over the driver tables: paged overlap, change history, product and
review jobs, refreshes, bootstrap, NULL rules and the lenient scalar parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import history as HI
from ..operators import latest as L
from ..operators import merge as M
from ..operators import pages as P
from ..operators import watermarks as H
from ..operators.filters import drop_blank
from ..session import ntz
from . import jobs as J
from .registry import register
from .sqlgen import date_lit
from .tables import EV_KNOWN, EV_STOCK_SEED, LI_TIEBREAK, RUN_1, RUN_2, table

# ================================================================ pages: A9, W2, U1, A7
PAGE_SIZE = 100


def review_rows(spark, sf):
    """Events as a paged review feed: branch = event type, newest first."""
    ev = table(spark, sf, "events")
    rows = ev.select(F.col("event_type").alias("branch_id"), F.col("event_id").alias("review_id"), "ts",
                     F.to_date("ts").alias("review_date"), F.col("user_id").alias("client_id"),
                     F.col("value"), F.col("props").alias("text"))
    return P.assign_pages(rows, "branch_id", [F.col("ts").desc_nulls_last(), F.col("review_id").desc_nulls_last()],
                          page_size=PAGE_SIZE)


def stored_reviews(spark, sf):
    ev = table(spark, sf, "events").where(F.col("ts") < ntz(EV_KNOWN))
    return ev.select(F.col("event_id").alias("review_id"), F.col("event_type").alias("branch_id"),
                     F.col("user_id").alias("client_id"), F.to_date("ts").alias("review_date"),
                     F.col("props").alias("text"), F.lit(RUN_1).alias("created_at"))


_PAGES_SQL = f"""
r AS (SELECT event_type AS branch_id, event_id AS review_id, ts, CAST(ts AS DATE) AS review_date,
             user_id AS client_id, props AS text,
             (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) // {PAGE_SIZE} AS page,
             (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) % {PAGE_SIZE} AS pos
      FROM events),
k AS (SELECT DISTINCT event_type AS branch_id, event_id AS review_id FROM events WHERE ts < TIMESTAMP '{EV_KNOWN}'),
f AS (SELECT branch_id, review_id, min(page) AS first_page FROM r GROUP BY branch_id, review_id),
st AS (SELECT r.branch_id, r.page, count(*) AS n_rows,
              count(DISTINCT CASE WHEN k.review_id IS NOT NULL OR f.first_page < r.page THEN r.review_id END) AS n_known
       FROM r JOIN f ON f.branch_id = r.branch_id AND f.review_id = r.review_id
       LEFT JOIN k ON k.branch_id = r.branch_id AND k.review_id = r.review_id
       GROUP BY r.branch_id, r.page),
s AS (SELECT branch_id, page, n_rows, n_known, n_known / n_rows AS dup_ratio FROM st),
c AS (SELECT a.branch_id, min(a.page) AS cut_page FROM s a
      JOIN s b ON b.branch_id = a.branch_id AND b.page = a.page - 1
      JOIN s c ON c.branch_id = a.branch_id AND c.page = a.page - 2
      WHERE a.dup_ratio >= 0.9 AND b.dup_ratio >= 0.9 AND c.dup_ratio >= 0.9 GROUP BY a.branch_id),
kept AS (SELECT s.* FROM s LEFT JOIN c ON c.branch_id = s.branch_id WHERE c.cut_page IS NULL OR s.page <= c.cut_page),
arch AS (SELECT r.* FROM r JOIN kept ON kept.branch_id = r.branch_id AND kept.page = r.page AND kept.dup_ratio < 1)
"""


def _page_stats(spark, sf):
    rows = review_rows(spark, sf)
    known = stored_reviews(spark, sf)
    return rows, P.page_overlap(rows, known, "branch_id", "page", "review_id")


@register("page_dup_ratio", "WITH " + _PAGES_SQL + "SELECT branch_id, page, n_rows, n_known, dup_ratio FROM s")
def page_dup_ratio(spark, sf):
    return _page_stats(spark, sf)[1]


@register("page_early_stop", "WITH " + _PAGES_SQL + "SELECT branch_id, page, n_rows, n_known, dup_ratio FROM kept")
def page_early_stop(spark, sf):
    return P.early_stop(_page_stats(spark, sf)[1])


@register("page_archive", "WITH " + _PAGES_SQL + "SELECT branch_id, review_id, page, pos FROM arch")
def page_archive(spark, sf):
    rows, stats = _page_stats(spark, sf)
    return P.pages_with_new_rows(rows, P.early_stop(stats)).select("branch_id", "review_id", "page", "pos")


@register("new_page_hwm", "WITH " + _PAGES_SQL +
          "SELECT branch_id, max(review_date) AS last_review_date FROM arch GROUP BY branch_id")
def new_page_hwm(spark, sf):
    rows, stats = _page_stats(spark, sf)
    return P.new_page_mark(P.pages_with_new_rows(rows, P.early_stop(stats)))


_REVIEW_TABLE_COLS = ["review_id", "branch_id", "client_id", "review_date", "text", "created_at"]


@register("reviews_flow", "WITH " + _PAGES_SQL + f""",
proc AS (SELECT r.* FROM r JOIN kept ON kept.branch_id = r.branch_id AND kept.page = r.page),
firsts AS (SELECT * FROM (SELECT proc.*, row_number() OVER (PARTITION BY review_id ORDER BY branch_id, page, pos) AS rn__
                          FROM proc) x WHERE rn__ = 1),
tgt AS (SELECT event_id AS review_id, event_type AS branch_id, user_id AS client_id, CAST(ts AS DATE) AS review_date,
               props AS text, {date_lit(RUN_1)} AS created_at FROM events WHERE ts < TIMESTAMP '{EV_KNOWN}')
SELECT * FROM tgt
UNION ALL
SELECT review_id, branch_id, client_id, review_date, text, {date_lit(RUN_2)} AS created_at FROM firsts
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.review_id = firsts.review_id)""")
def reviews_flow(spark, sf):
    out = J.reviews_job(review_rows(spark, sf), stored_reviews(spark, sf), H.empty_hwm(spark, "timestamp", "date"),
                        RUN_2)
    return out["reviews"].select(*_REVIEW_TABLE_COLS)


@register("reviews_flow_hwm", "WITH " + _PAGES_SQL + f"""
SELECT 'reviews_api' AS entity, branch_id, CAST(max(review_date) AS TIMESTAMP) AS last_updated,
       {date_lit(RUN_2)} AS created_at, {date_lit(RUN_2)} AS updated_at FROM arch GROUP BY branch_id""")
def reviews_flow_hwm(spark, sf):
    out = J.reviews_job(review_rows(spark, sf), stored_reviews(spark, sf), H.empty_hwm(spark, "timestamp", "date"),
                        RUN_2)
    return out["hwm"].withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


# ================================================================ W1 change history, A11 view
_CH_KEYS = ["user_id", "event_type"]


def _stock_obs(spark, sf):
    ev = table(spark, sf, "events").withColumn("quantity", F.floor(F.col("value") / 10).cast("long"))
    current = L.latest_by_key(ev.where(F.col("ts") < ntz(EV_STOCK_SEED)), _CH_KEYS, "ts", ["event_id"])
    obs = ev.where(F.col("ts") >= ntz(EV_STOCK_SEED)).withColumnRenamed("value", "price")
    return current.select(*_CH_KEYS, "quantity"), obs


_CH_SQL = f"""
WITH cur AS (SELECT user_id, event_type, quantity, TRUE AS ex FROM (
        SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS quantity,
               row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn__
        FROM events WHERE ts < TIMESTAMP '{EV_STOCK_SEED}') x WHERE rn__ = 1),
o AS (SELECT user_id, event_type, ts, event_id, CAST(floor(value / 10) AS BIGINT) AS quantity, value AS price,
             lag(CAST(floor(value / 10) AS BIGINT)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev_q,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn__
      FROM events WHERE ts >= TIMESTAMP '{EV_STOCK_SEED}'),
h AS (SELECT o.user_id, o.event_type, o.ts AS snapshot_time, o.quantity, o.price, 'sync' AS source
      FROM o LEFT JOIN cur ON cur.user_id = o.user_id AND cur.event_type = o.event_type
      WHERE CASE WHEN o.rn__ = 1 THEN cur.ex IS NULL OR o.quantity IS DISTINCT FROM cur.quantity
                 ELSE o.quantity IS DISTINCT FROM o.prev_q END)
"""


def _history(spark, sf, **split_opts):
    current, obs = _stock_obs(spark, sf)
    return HI.change_history(obs, current, _CH_KEYS, "quantity", ["ts", "event_id"], carry=["price"],
                             time_col="ts", **split_opts)


@register("change_history", _CH_SQL + "SELECT * FROM h")
def change_history(spark, sf):
    return _history(spark, sf)


@register("change_history_split", _CH_SQL + "SELECT * FROM h")
def change_history_split(spark, sf):
    """Same rows over four ranges, whose borders cut through keys."""
    return _history(spark, sf, ranges=4)


@register("daily_stock_levels", _CH_SQL + """
SELECT event_type AS branch_id, user_id AS product_id, stock_date, quantity_in_stock, price FROM (
  SELECT event_type, user_id, CAST(snapshot_time AS DATE) AS stock_date, quantity AS quantity_in_stock, price,
         row_number() OVER (PARTITION BY event_type, user_id, CAST(snapshot_time AS DATE) ORDER BY snapshot_time DESC) AS rn__
  FROM h) x WHERE rn__ = 1""")
def daily_stock_levels(spark, sf):
    """The daily stock view (K4) over the change history."""
    h = _history(spark, sf).select(F.col("event_type").alias("branch_id"), F.col("user_id").alias("product_id"),
                                   "snapshot_time", F.col("quantity").alias("quantity_in_stock"), "price")
    return L.last_value_per_day(h, ["branch_id", "product_id"], "snapshot_time", ["quantity_in_stock", "price"])


@register("page_positions_split", """
SELECT event_type AS branch_id, event_id AS review_id,
       (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) // 7 AS page,
       (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) % 7 AS pos
FROM events""")
def page_positions_split(spark, sf):
    """Page numbering over sixteen ranges, whose borders cut through branches."""
    ev = table(spark, sf, "events").select(F.col("event_type").alias("branch_id"),
                                           F.col("event_id").alias("review_id"), "ts")
    return P.assign_pages(ev, "branch_id", [F.col("ts").desc(), F.col("review_id").desc()],
                          page_size=7, ranges=16).select("branch_id", "review_id", "page", "pos")


# ================================================================ products flow (T7 on lineitem)
_PF_CUT = "1998-01-01 00:00:00"
_PF_NOW = "2001-06-01 00:00:00"
_PF_SEQ = ["l_shipdate", "l_orderkey", "l_linenumber"] + LI_TIEBREAK


def _product_obs(spark, sf):
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    obs = li.join(part, li.l_partkey == part.p_partkey, "inner").select(
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").cast("string").alias("branch_id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") < 10, F.lit("")).otherwise(F.col("p_brand")).alias("brand_name"),
        F.col("p_type").alias("type_raw"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity_in_stock"),
        F.col("l_shipdate").alias("updated_at_ph"), *_PF_SEQ)
    return obs


def _products(spark, sf, want):
    obs = _product_obs(spark, sf)
    early = obs.where(F.col("updated_at_ph") < ntz(_PF_CUT))
    stock0 = L.latest_by_key(early, ["product_id", "branch_id"], order=[F.col(s).desc_nulls_last() for s in _PF_SEQ])
    stock0 = J.product_rows(stock0).select("product_id", "branch_id", "price", "quantity_in_stock", "updated_at_ph",
                                           F.lit(RUN_1).alias("last_synced_at"))
    master0 = (L.latest_by_key(J.product_rows(early).withColumn("id", F.col("product_id")), ["id"],
                               order=[F.col("branch_id").desc()] + [F.col(s).desc_nulls_last() for s in _PF_SEQ])
                .select("id", "name", "brand_name", "type_raw", "updated_at_ph",
                        F.lit(RUN_1).alias("inserted_at"), F.lit(RUN_1).alias("updated_at")))
    hwm0 = H.merge_hwm(H.empty_hwm(spark, "timestamp_ntz", "date"),
                       H.seed_hwm(early, "products_api", "updated_at_ph", branch="branch_id"), RUN_1)
    feed = obs.where(F.col("updated_at_ph") >= ntz(_PF_CUT))
    return J.products_job(feed, master0, stock0, hwm0, _PF_SEQ, RUN_2, now=ntz(_PF_NOW), outputs=(want,))


_PF_OBS_SQL = f"""
obs AS (SELECT l_partkey AS product_id, CAST(l_suppkey AS VARCHAR) AS branch_id, p_name AS name,
               NULLIF(CASE WHEN p_size < 10 THEN '' ELSE p_brand END, '') AS brand_name, NULLIF(p_type, '') AS type_raw,
               CASE WHEN l_extendedprice <> 0 THEN l_extendedprice END AS price,
               COALESCE(l_quantity, 0.0) AS quantity_in_stock, l_shipdate AS updated_at_ph,
               {', '.join(_PF_SEQ)}
        FROM lineitem JOIN part ON l_partkey = p_partkey),
early AS (SELECT * FROM obs WHERE updated_at_ph < TIMESTAMP '{_PF_CUT}'),
hwm0 AS (SELECT branch_id, max(updated_at_ph) AS mark FROM early GROUP BY branch_id),
feed AS (SELECT obs.* FROM obs LEFT JOIN hwm0 ON hwm0.branch_id = obs.branch_id
         WHERE obs.updated_at_ph >= TIMESTAMP '{_PF_CUT}'
           AND (hwm0.mark IS NULL OR (obs.updated_at_ph > hwm0.mark AND obs.updated_at_ph <= TIMESTAMP '{_PF_NOW}'))),
stock0 AS (SELECT product_id, branch_id, quantity_in_stock FROM (
           SELECT *, row_number() OVER (PARTITION BY product_id, branch_id
                 ORDER BY {', '.join(s + ' DESC' for s in _PF_SEQ)}) AS rn__ FROM early) x WHERE rn__ = 1)
"""


@register("products_flow", "WITH " + _PF_OBS_SQL + f""",
s0 AS (SELECT product_id, branch_id, price, quantity_in_stock, updated_at_ph, {date_lit(RUN_1)} AS last_synced_at FROM (
       SELECT *, row_number() OVER (PARTITION BY product_id, branch_id
             ORDER BY {', '.join(s + ' DESC' for s in _PF_SEQ)}) AS rn__ FROM early) x WHERE rn__ = 1),
s1 AS (SELECT product_id, branch_id, price, quantity_in_stock, updated_at_ph FROM (
       SELECT *, row_number() OVER (PARTITION BY product_id, branch_id
             ORDER BY {', '.join(s + ' DESC' for s in _PF_SEQ)}) AS rn__ FROM feed) x WHERE rn__ = 1)
SELECT COALESCE(s0.product_id, s1.product_id) AS product_id, COALESCE(s0.branch_id, s1.branch_id) AS branch_id,
       CASE WHEN s1.product_id IS NOT NULL THEN s1.price ELSE s0.price END AS price,
       CASE WHEN s1.product_id IS NOT NULL THEN s1.quantity_in_stock ELSE s0.quantity_in_stock END AS quantity_in_stock,
       CASE WHEN s1.product_id IS NOT NULL THEN s1.updated_at_ph ELSE s0.updated_at_ph END AS updated_at_ph,
       CASE WHEN s1.product_id IS NOT NULL THEN {date_lit(RUN_2)} ELSE s0.last_synced_at END AS last_synced_at
FROM s0 FULL OUTER JOIN s1 ON s0.product_id = s1.product_id AND s0.branch_id = s1.branch_id""")
def products_flow(spark, sf):
    return _products(spark, sf, "stock")["stock"]


@register("products_history", "WITH " + _PF_OBS_SQL + f""",
o AS (SELECT feed.*, lag(quantity_in_stock) OVER w AS prev_q, row_number() OVER w AS rn__
      FROM feed WINDOW w AS (PARTITION BY product_id, branch_id ORDER BY {', '.join(_PF_SEQ)}))
SELECT o.product_id, o.branch_id, {date_lit(RUN_2)} AS snapshot_time, o.quantity_in_stock, o.price, 'sync' AS source
FROM o LEFT JOIN (SELECT *, TRUE AS ex FROM stock0) c ON c.product_id = o.product_id AND c.branch_id = o.branch_id
WHERE CASE WHEN o.rn__ = 1 THEN c.ex IS NULL OR o.quantity_in_stock IS DISTINCT FROM c.quantity_in_stock
           ELSE o.quantity_in_stock IS DISTINCT FROM o.prev_q END""")
def products_history(spark, sf):
    return _products(spark, sf, "history")["history"]


@register("products_master", "WITH " + _PF_OBS_SQL + f""",
m0 AS (SELECT product_id AS id, name, brand_name, type_raw, updated_at_ph, {date_lit(RUN_1)} AS inserted_at,
              {date_lit(RUN_1)} AS updated_at FROM (
       SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY branch_id DESC,
             {', '.join(s + ' DESC' for s in _PF_SEQ)}) AS rn__ FROM early) x WHERE rn__ = 1),
m1 AS (SELECT product_id AS id, name, brand_name, type_raw, updated_at_ph FROM (
       SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY branch_id DESC,
             {', '.join(s + ' DESC' for s in _PF_SEQ)}) AS rn__ FROM feed) x WHERE rn__ = 1)
SELECT COALESCE(m0.id, m1.id) AS id,
       CASE WHEN m1.id IS NOT NULL THEN m1.name ELSE m0.name END AS name,
       CASE WHEN m1.id IS NOT NULL THEN m1.brand_name ELSE m0.brand_name END AS brand_name,
       CASE WHEN m1.id IS NOT NULL THEN m1.type_raw ELSE m0.type_raw END AS type_raw,
       CASE WHEN m1.id IS NOT NULL THEN m1.updated_at_ph ELSE m0.updated_at_ph END AS updated_at_ph,
       COALESCE(m0.inserted_at, {date_lit(RUN_2)}) AS inserted_at,
       CASE WHEN m1.id IS NOT NULL THEN {date_lit(RUN_2)} ELSE m0.updated_at END AS updated_at
FROM m0 FULL OUTER JOIN m1 ON m0.id = m1.id""")
def products_master(spark, sf):
    return _products(spark, sf, "master")["master"]


@register("products_hwm", "WITH " + _PF_OBS_SQL + f"""
SELECT 'products_api' AS entity, COALESCE(h.branch_id, n.branch_id) AS branch_id,
       greatest(h.mark, n.mark) AS last_updated,
       CASE WHEN h.mark IS NOT NULL THEN {date_lit(RUN_1)} ELSE {date_lit(RUN_2)} END AS created_at,
       CASE WHEN n.mark IS NOT NULL THEN {date_lit(RUN_2)} ELSE {date_lit(RUN_1)} END AS updated_at
FROM hwm0 h FULL OUTER JOIN (SELECT branch_id, max(updated_at_ph) AS mark FROM feed GROUP BY branch_id) n
  ON n.branch_id = h.branch_id""")
def products_hwm(spark, sf):
    return _products(spark, sf, "hwm")["hwm"]


# ================================================================ T8 refresh (staff per branch)
_STAFF_COLS = ["staff_id", "branch_id", "first_name", "acct", "created_at", "updated_at"]


@register("refresh_dims", f"""
WITH t AS (SELECT s_suppkey AS staff_id, CAST(s_nationkey AS VARCHAR) AS branch_id, s_name AS first_name,
                  s_acctbal AS acct, {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at
           FROM supplier WHERE s_acctbal < 5000),
l AS (SELECT s_suppkey AS staff_id, CAST(s_nationkey AS VARCHAR) AS branch_id, upper(s_name) AS first_name,
             s_acctbal AS acct FROM supplier)
SELECT COALESCE(t.staff_id, l.staff_id) AS staff_id, COALESCE(t.branch_id, l.branch_id) AS branch_id,
       CASE WHEN l.staff_id IS NOT NULL THEN l.first_name ELSE t.first_name END AS first_name,
       CASE WHEN l.staff_id IS NOT NULL THEN l.acct ELSE t.acct END AS acct,
       COALESCE(t.created_at, {date_lit(RUN_2)}) AS created_at,
       CASE WHEN l.staff_id IS NOT NULL THEN {date_lit(RUN_2)} ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN l ON t.staff_id = l.staff_id AND t.branch_id = l.branch_id""")
def refresh_dims(spark, sf):
    sup = table(spark, sf, "supplier")
    staff = sup.select(F.col("s_suppkey").alias("staff_id"), F.col("s_nationkey").cast("string").alias("branch_id"),
                       F.col("s_name").alias("first_name"), F.col("s_acctbal").alias("acct"))
    target = M.table_from_source(staff.where(F.col("acct") < 5000), _STAFF_COLS, "created_at", "updated_at", RUN_1)
    landed = staff.withColumn("first_name", F.upper("first_name"))
    out = J.refresh_job(landed, target, ["staff_id", "branch_id"], H.empty_hwm(spark, "timestamp", "date"),
                        "staff_api", RUN_2)
    return out["table"]


@register("refresh_dims_hwm", f"""
SELECT DISTINCT 'staff_api' AS entity, CAST(s_nationkey AS VARCHAR) AS branch_id,
       TIMESTAMP '{RUN_2.isoformat()} 00:00:00' AS last_updated, {date_lit(RUN_2)} AS created_at,
       {date_lit(RUN_2)} AS updated_at FROM supplier""")
def refresh_dims_hwm(spark, sf):
    sup = table(spark, sf, "supplier")
    staff = sup.select(F.col("s_suppkey").alias("staff_id"), F.col("s_nationkey").cast("string").alias("branch_id"))
    target = staff.limit(0)
    out = J.refresh_job(staff, target, ["staff_id", "branch_id"], H.empty_hwm(spark, "timestamp_ntz", "date"),
                        "staff_api", RUN_2)
    return out["hwm"].withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


# ================================================================ T1-T3 bootstrap, T11 empty window
@register("bootstrap_seed", f"""
SELECT 'transactions_csv' AS entity, CAST(l_suppkey AS VARCHAR) AS branch_id, max(l_shipdate) AS last_updated,
       {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at FROM lineitem GROUP BY l_suppkey
UNION ALL
SELECT 'clients_csv', 'ALL', max(ts), {date_lit(RUN_1)}, {date_lit(RUN_1)} FROM events""")
def bootstrap_seed(spark, sf):
    hwm0 = H.empty_hwm(spark, "timestamp_ntz", "date")
    seeded = J.bootstrap(hwm0, table(spark, sf, "lineitem"), table(spark, sf, "events"), RUN_1,
                         item_version="l_shipdate", item_branch="l_suppkey", client_version="ts")
    # a second run finds the marks and leaves them untouched
    return J.bootstrap(seeded, table(spark, sf, "lineitem"), table(spark, sf, "events"), RUN_2,
                       item_version="l_shipdate", item_branch="l_suppkey", client_version="ts")


_CLIENT_COLS = ["user_id", "event_id", "ts", "value", "created_at", "updated_at"]


@register("empty_window", f"""
SELECT user_id, event_id, ts, value, {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn__ FROM events) x WHERE rn__ = 1""")
def empty_window(spark, sf):
    """A window with no new rows leaves the table and its mark unchanged."""
    ev = table(spark, sf, "events")
    target = M.table_from_source(L.latest_by_key(ev, ["user_id"], "ts", ["event_id"]), _CLIENT_COLS,
                                 "created_at", "updated_at", RUN_1)
    hwm = H.merge_hwm(H.empty_hwm(spark, "timestamp_ntz", "date"), H.seed_hwm(ev, "clients_csv", "ts"), RUN_1)
    batch = H.incremental_window(ev, hwm, "ts", "after", entity="clients_csv").drop("entity")
    out = J.import_batch(target, batch, ["user_id"], "ts", ["event_id"], hwm, "clients_csv", RUN_2)
    return out["table"]


# ================================================================ P1-P3, P9-P11, F20
@register("drop_blank_keys", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name FROM part WHERE p_size >= 5""")
def drop_blank_keys(spark, sf):
    part = table(spark, sf, "part")
    dirty = part.select(F.when(F.col("p_size") < 5, F.lit("")).otherwise(F.col("p_partkey").cast("string"))
                         .alias("product_id"), F.col("p_name").alias("name"))
    return drop_blank(dirty, ["product_id"])


@register("null_rules", """
SELECT p_partkey AS id, p_name AS name,
       NULLIF(CASE WHEN p_size < 10 THEN '' ELSE p_brand END, '') AS brand_name,
       NULLIF(CASE WHEN p_size BETWEEN 20 AND 24 THEN '' ELSE p_type END, '') AS type_raw,
       CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice END AS price,
       CAST(CASE WHEN p_size < 8 THEN 0 ELSE p_size END AS DOUBLE) AS quantity_in_stock
FROM part""")
def null_rules(spark, sf):
    part = table(spark, sf, "part")
    raw = part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") < 10, F.lit("")).otherwise(F.col("p_brand")).alias("brand_name"),
        F.when(F.col("p_size").between(20, 24), F.lit("")).otherwise(F.col("p_type")).alias("type_raw"),
        F.when(F.col("p_size") > 45, F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(F.col("p_size") < 8, F.lit(0.0)).otherwise(F.col("p_size").cast("double")).alias("quantity_in_stock"))
    return J.product_rows(raw)


# ================================================================ F1-F13 lenient parsing
def _dirty(ev):
    """Event columns written as text, dirtied by a fixed rule per event_id % 7."""
    b = F.col("event_id") % 7
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    uid = F.col("user_id").cast("string")
    ts = F.col("ts")
    num = (F.when(b == 0, F.concat(F.lit(" "), cents, F.lit("e-2 ")))
            .when(b == 1, F.lit("")).when(b == 2, F.col("event_type"))
            .when(b == 3, F.concat(cents, F.lit("d"))).when(b == 4, F.concat(F.lit("+"), cents))
            .when(b == 5, F.concat(F.lit(" "), cents, F.lit("　"))).otherwise(F.lit(".5")))
    num_null = F.when(b == 1, F.lit("   ")).when(b == 6, F.lit("1e400")).otherwise(num)
    integer = (F.when(b == 0, F.concat(F.lit(" "), uid, F.lit(" "))).when(b == 1, F.concat(uid, F.lit(".5")))
                .when(b == 2, F.lit("99999999999999999999")).when(b == 3, F.concat(F.lit("-"), uid))
                .when(b == 4, F.lit("")).otherwise(uid))
    flag = (F.when(b == 0, F.lit("Y")).when(b == 1, F.lit("TRUE")).when(b == 2, F.lit("on"))
             .when(b == 3, F.lit("")).when(b == 4, F.lit(" t ")).when(b == 5, F.lit("no")).otherwise(F.lit("1")))
    date = (F.when(b == 0, F.date_format(ts, "yyyy-MM-dd")).when(b == 1, F.date_format(ts, "yyyy-M-d"))
             .when(b == 2, F.date_format(ts, "yyyy-13-dd")).when(b == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
             .when(b == 4, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
             .when(b == 5, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("")))
    clock = (F.when(b == 0, F.date_format(ts, "H:mm")).when(b == 1, F.date_format(ts, "HH:mm:ss"))
              .when(b == 2, F.date_format(ts, "HH:mm:ss.SSS")).when(b == 3, F.lit("x"))
              .when(b == 4, F.date_format(ts, "HH:mm:ss.SSSSSS")).otherwise(F.lit("")))
    stamp = (F.when(b == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+01:00'"))
              .when(b == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
              .when(b == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
              .when(b == 3, F.date_format(ts, "yyyy")).when(b == 4, F.date_format(ts, "yyyy-MM-dd"))
              .when(b == 5, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise(F.lit("")))
    text = F.when(b == 0, F.concat(F.lit("a��b "), F.col("event_type"))).otherwise(F.col("event_type"))
    return ev.select("event_id", num.alias("num_txt"), num_null.alias("numn_txt"), integer.alias("int_txt"),
                     flag.alias("bool_txt"), date.alias("date_txt"), clock.alias("clock_txt"),
                     stamp.alias("ts_txt"), text.alias("free_txt"))


_PARSE_SQL = """
SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN round(value * 100) / 100 WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0
       WHEN 4 THEN round(value * 100) WHEN 5 THEN round(value * 100) ELSE 0.5 END AS num,
  CASE event_id % 7 WHEN 0 THEN round(value * 100) / 100 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL
       WHEN 4 THEN round(value * 100) WHEN 5 THEN round(value * 100) ELSE NULL END AS num_nullable,
  CASE event_id % 7 WHEN 0 THEN user_id WHEN 1 THEN 0 WHEN 2 THEN 9223372036854775807 WHEN 3 THEN -user_id
       WHEN 4 THEN 0 ELSE user_id END AS int_v,
  event_id % 7 IN (0, 1, 4, 6) AS flag,
  CASE WHEN event_id % 7 = 0 THEN CAST(ts AS DATE) END AS day_v,
  CASE WHEN event_id % 7 IN (0, 3, 4) THEN CAST(ts AS DATE) END AS day3_v,
  CASE event_id % 7 WHEN 0 THEN strftime(ts, '%H:%M') || ':00.000' WHEN 1 THEN strftime(ts, '%H:%M:%S') || '.000'
       WHEN 2 THEN strftime(ts, '%H:%M:%S.%g') WHEN 4 THEN strftime(ts, '%H:%M:%S.%g') END AS clock_v,
  CASE event_id % 7 WHEN 0 THEN epoch_us(date_trunc('second', ts) - INTERVAL 1 HOUR)
       WHEN 1 THEN epoch_us(date_trunc('second', ts)) WHEN 2 THEN epoch_us(ts) WHEN 5 THEN epoch_us(ts) END AS ts_us,
  CASE WHEN event_id % 7 = 0 THEN 'a?b ' || event_type ELSE event_type END AS clean_v
FROM events"""


@register("parse_scalars", _PARSE_SQL)
def parse_scalars(spark, sf):
    d = _dirty(table(spark, sf, "events"))
    return d.select(
        "event_id",
        S.lenient_double("num_txt").alias("num"),
        S.lenient_double("numn_txt", None).alias("num_nullable"),
        S.lenient_long("int_txt").alias("int_v"),
        S.lenient_bool("bool_txt").alias("flag"),
        S.lenient_date("date_txt").alias("day_v"),
        S.lenient_date3("date_txt").alias("day3_v"),
        S.lenient_clock("clock_txt").alias("clock_v"),
        F.unix_micros(S.lenient_ts("ts_txt")).alias("ts_us"),
        S.clean_text("free_txt").alias("clean_v"))


@register("page_positions_hot", """
SELECT 'all' AS branch_id, event_id AS review_id,
       (row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1) // 100 AS page,
       (row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1) % 100 AS pos
FROM events""")
def page_positions_hot(spark, sf):
    """Every event in one branch -- a single group holding all rows -- paged
    over 32 ranges instead of in one task."""
    ev = table(spark, sf, "events").select(F.lit("all").alias("branch_id"), F.col("event_id").alias("review_id"), "ts")
    return P.assign_pages(ev, "branch_id", [F.col("ts").desc(), F.col("review_id").desc()],
                          page_size=100, ranges=32).select(
        "branch_id", "review_id", "page", "pos")


@register("change_history_hot", """
SELECT 'all' AS product_id, ts AS snapshot_time, quantity, value AS price, 'sync' AS source FROM (
  SELECT ts, value, CAST(floor(value / 10) AS BIGINT) AS quantity,
         lag(CAST(floor(value / 10) AS BIGINT)) OVER (ORDER BY ts, event_id) AS prev_q,
         row_number() OVER (ORDER BY ts, event_id) AS rn__
  FROM events) x
WHERE rn__ = 1 OR quantity IS DISTINCT FROM prev_q""")
def change_history_hot(spark, sf):
    """Every event as an observation of ONE product -- a single key holding all
    rows -- so the previous-state lookup carries over 31 borders."""
    ev = table(spark, sf, "events").select(F.lit("all").alias("product_id"), "ts", "event_id",
                                           F.floor(F.col("value") / 10).cast("long").alias("quantity"),
                                           F.col("value").alias("price"))
    return HI.change_history(ev, None, ["product_id"], "quantity", ["ts", "event_id"], carry=["price"],
                             time_col="ts", ranges=32)


@register("hot_equal_lead", """
SELECT 'all' AS product_id, event_id, quantity, 'sync' AS source FROM (
  SELECT event_id, CAST(floor(value / 10) AS BIGINT) AS quantity,
         lag(CAST(floor(value / 10) AS BIGINT)) OVER (ORDER BY event_id) AS prev_q,
         row_number() OVER (ORDER BY event_id) AS rn__
  FROM events) x
WHERE rn__ = 1 OR quantity IS DISTINCT FROM prev_q""")
def hot_equal_lead(spark, sf):
    """Every event as an observation of one product on one day: one key, one leading
    value. The ranges are cut by the whole order, so the work still spreads."""
    ev = table(spark, sf, "events").select(F.lit("all").alias("product_id"), F.lit(RUN_1).alias("day"), "event_id",
                                           F.floor(F.col("value") / 10).cast("long").alias("quantity"))
    return HI.change_history(ev, None, ["product_id"], "quantity", ["day", "event_id"], carry=["event_id"],
                             time_col="day", ranges=32).select("product_id", "event_id", "quantity", "source")
