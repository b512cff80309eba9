"""Sources and sinks over the driver tables: rows are landed as CSV exports or
JSON page envelopes in a fresh folder under the checkpoint root, read back
with the lenient readers, merged, published and streamed. Oracles compute the
same rows straight from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import latest as L
from ..operators import merge as M
from ..operators import watermarks as H
from ..session import ntz, scratch_path
from ..sources import csv as C
from ..sources import pages as PG
from ..sources import sinks as K
from ..sources import snapshots as SN
from ..sources.specs import REVIEWS, FeedSpec, _parse
from ..streaming.stream import stream_merge
from .q_core import _T_ITEMS, MERGE_NEWER_SQL, _items_source, _items_target
from .q_flows import review_rows
from .registry import register
from .sqlgen import date_lit, latest_sql, merge_sql, order_sql
from .tables import EV_EARLY, LI_COLS, LI_KEY, LI_TIEBREAK, LI_VERSION, RUN_1, RUN_2, table


# ================================================================ K1 -> S3/S6 round trip
def _events_as_reviews(ev):
    """Events rendered as review rows (text with quotes, commas and newlines)."""
    return ev.select(
        F.col("event_id").cast("string").alias("review_id"), F.col("event_type").alias("branch_id"),
        F.col("user_id").cast("string").alias("client_id"), F.col("props").alias("client_first_name"),
        F.lit("").alias("client_last_name"), F.to_date("ts").alias("review_date"),
        F.lit(None).cast("date").alias("visit_date"), F.lit("").alias("staff_id"),
        F.concat(F.lit("O'Neil, "), F.col("event_type")).alias("staff_first_name"),
        F.lit("").alias("staff_last_name"),
        F.concat(F.col("props"), F.lit("\n\"quoted\", "), F.col("event_type")).alias("text"),
        F.floor("value").cast("long").alias("rating"), (F.col("value") > 50).alias("facebook_review"),
        F.lit(False).alias("twitter_review"))


_REVIEWS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS branch_id, CAST(user_id AS VARCHAR) AS client_id,
       props AS client_first_name, '' AS client_last_name, CAST(ts AS DATE) AS review_date,
       CAST(NULL AS DATE) AS visit_date, '' AS staff_id, 'O''Neil, ' || event_type AS staff_first_name,
       '' AS staff_last_name, props || chr(10) || '"quoted", ' || event_type AS text,
       CAST(floor(value) AS BIGINT) AS rating, value > 50 AS facebook_review, FALSE AS twitter_review
FROM events"""


@register("csv_roundtrip", _REVIEWS_SQL)
def csv_roundtrip(spark, sf):
    """K1 writer -> S3 reader (first bad file would fail the load: S6)."""
    out = scratch_path(spark, "reviews-csv")
    K.write_csv(_events_as_reviews(table(spark, sf, "events")), out, REVIEWS)
    return C.read_csv_dir(spark, out, REVIEWS, on_bad_file="fail").rows.drop("_file", "_row")


@register("csv_parallel_quotes", _REVIEWS_SQL)
def csv_parallel_quotes(spark, sf):
    """Files whose fields hold line breaks, read line by line in splits and not one task each."""
    out = scratch_path(spark, "reviews-csv")
    K.write_csv(_events_as_reviews(table(spark, sf, "events")), out, REVIEWS)
    return C.read_csv_dir(spark, out, REVIEWS, on_bad_file="fail", large=0).rows.drop("_file", "_row")


def _land_with_bad_files(spark, sf):
    """Good files for every event type but 'error', whose files are written
    without quoting so a comma inside a field makes every record ragged."""
    ev = _events_as_reviews(table(spark, sf, "events"))
    root = scratch_path(spark, "reviews-landing")
    K.write_csv(ev.where(F.col("branch_id") != "error"), f"{root}/good", REVIEWS)
    bad = K.as_csv_text(ev.where(F.col("branch_id") == "error"), REVIEWS)
    (bad.write.option("header", True).option("quote", "").option("escapeQuotes", False)
        .csv(f"{root}/bad"))
    return C.read_csv_dir(spark, [f"{root}/good", f"{root}/bad"], REVIEWS, on_bad_file="skip")


@register("csv_quarantine", _REVIEWS_SQL + " WHERE event_type <> 'error'")
def csv_quarantine(spark, sf):
    return _land_with_bad_files(spark, sf).rows.drop("_file", "_row")


@register("import_counts", """
SELECT TRUE AS ok, count(*) AS n_rows, count(DISTINCT event_id) AS n_keys FROM events WHERE event_type <> 'error'
UNION ALL SELECT FALSE, 0, 0""")
def import_counts(spark, sf):
    """Per-file run metrics (A12) rolled up by outcome: loaded rows and keys."""
    per_file = C.import_counts(_land_with_bad_files(spark, sf), "review_id")
    return per_file.groupBy("ok").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_keys").alias("n_keys"))


# ================================================================ P4 header binding by name
_HEADER_VARIANTS = {  # event type -> (rotation of the column order, upper-case+spaced names, dropped column)
    "click": (0, False, None), "view": (3, True, "client_first_name"), "purchase": (7, False, "staff_id"),
    "signup": (11, True, None), "error": (5, False, "text"),
}


@register("csv_header_groups", """
SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS branch_id, CAST(user_id AS VARCHAR) AS client_id,
       CASE WHEN event_type = 'view' THEN '' ELSE props END AS client_first_name, '' AS client_last_name,
       CAST(ts AS DATE) AS review_date, CAST(NULL AS DATE) AS visit_date, '' AS staff_id,
       'O''Neil, ' || event_type AS staff_first_name, '' AS staff_last_name,
       CASE WHEN event_type = 'error' THEN '' ELSE props || chr(10) || '"quoted", ' || event_type END AS text,
       CAST(floor(value) AS BIGINT) AS rating, value > 50 AS facebook_review, FALSE AS twitter_review
FROM events""")
def csv_header_groups(spark, sf):
    """Files whose headers differ in order, case, padding and column set."""
    ev = K.as_csv_text(_events_as_reviews(table(spark, sf, "events")), REVIEWS)
    root = scratch_path(spark, "reviews-headers")
    names = [c for c, _, _ in REVIEWS.columns]
    for etype, (rot, shout, dropped) in _HEADER_VARIANTS.items():
        cols = [c for c in names[rot:] + names[:rot] if c != dropped]
        part = ev.where(F.col("branch_id") == etype).select(
            *[F.col(c).alias(f" {c.upper()} " if shout else c) for c in cols])
        (part.write.option("header", True).option("quote", '"').option("escape", '"')
             .option("emptyValue", "").csv(f"{root}/{etype}"))
    return C.read_csv_dir(spark, [f"{root}/{t}" for t in _HEADER_VARIANTS], REVIEWS).rows.drop("_file", "_row")


# ================================================================ S9/S12 JSON envelopes
@register("json_pages", """
SELECT event_type AS branch_id,
       (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) // 100 AS page,
       (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) % 100 AS pos,
       CAST(event_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS client_id,
       CAST(ts AS DATE) AS review_date, CAST(floor(value) AS BIGINT) AS rating, props AS text,
       '' AS staff_id, FALSE AS twitter_review
FROM events""")
def json_pages(spark, sf):
    rows = review_rows(spark, sf).select(
        "branch_id", "page", "pos", F.col("review_id").cast("string").alias("review_id"),
        F.col("client_id").cast("string").alias("client_id"),
        F.date_format("review_date", "yyyy-MM-dd").alias("review_date"),
        F.floor("value").cast("long").alias("rating"), "text")
    root = scratch_path(spark, "reviews-pages")
    PG.write_pages(rows, root, "reviews", page_size=100)
    got, _ = PG.read_pages(spark, root, "reviews")
    got = PG.parse_item_times(got, "reviews")
    return got.select("branch_id", "page", "pos", "review_id", "client_id", "review_date", "rating", "text",
                      "staff_id", "twitter_review")


@register("json_page_counts", """
SELECT event_type AS branch_id, page, count(*) AS n_rows, max(page) OVER (PARTITION BY event_type) + 1 AS total_pages
FROM (SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) - 1) // 100 AS page
      FROM events) x GROUP BY event_type, page""")
def json_page_counts(spark, sf):
    rows = review_rows(spark, sf).select("branch_id", "page", "pos", F.col("review_id").cast("string").alias("review_id"))
    root = scratch_path(spark, "reviews-pages")
    PG.write_pages(rows, root, "reviews", page_size=100)
    _, pages = PG.read_pages(spark, root, "reviews")
    from ..operators.pages import valid_pages
    return valid_pages(pages).select("branch_id", "page", "n_rows", "total_pages")


# ================================================================ K3/T12/S13/W4 publish
@register("publish_roundtrip", MERGE_NEWER_SQL)
def publish_roundtrip(spark, sf):
    """Run 1 publishes headers + items, run 2 publishes merged items only;
    the manifest resolves items to run 2 and headers to run 1."""
    root = scratch_path(spark, "hub")
    SN.publish(spark, root, "20240101000000", {"headers": table(spark, sf, "orders"),
                                               "items": _items_target(spark, sf)})
    items = SN.read_table(spark, root, "items")
    merged = M.merge(items, _items_source(spark, sf), LI_KEY, "newer", LI_VERSION,
                     created_col="created_at", updated_col="updated_at", run_ts=RUN_2)
    SN.publish(spark, root, "20240201000000", {"items": merged})
    return SN.read_table(spark, root, "items")


@register("publish_lookup", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 1""")
def publish_lookup(spark, sf):
    """``First`` (smallest key) of a published table read back by manifest."""
    root = scratch_path(spark, "hub")
    SN.publish(spark, root, "20240101000000", {"headers": table(spark, sf, "orders")})
    return SN.first_by_key(SN.read_table(spark, root, "headers"), "o_orderkey")


# ================================================================ T4/T5/T9 streaming import
EVENTS_FEED = FeedSpec("events", _parse("""
event_id long?
ts ts_ntz
user_id long?
event_type text
value double?
props text
"""), key=("event_type",), clean="none")


@register("stream_merge", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn__ FROM events) x
WHERE rn__ = 1""")
def stream_merge_q(spark, sf):
    """Two landed export sets drained by a file stream in several micro-batches;
    each batch is merged newer-wins and published with its mark."""
    ev = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.col("value").cast("string").alias("value"), "props", F.col("user_id").alias("_k"), F.col("ts").alias("_ts"))
    landing = scratch_path(spark, "landing")
    for part in (ev.where(F.col("_ts") < ntz(EV_EARLY)), ev.where(F.col("_ts") >= ntz(EV_EARLY))):
        # all rows of one key land in the same file, so per-file order is the version order
        (part.repartition(3, "_k").drop("_k", "_ts").write.mode("append").option("header", True)
             .option("quote", '"').option("escape", '"').option("emptyValue", "").csv(landing))
    root = scratch_path(spark, "hub")
    q = stream_merge(spark, landing, EVENTS_FEED, root, scratch_path(spark, "stream-ckpt"), table="clients",
                     keys=["user_id", "event_type"], version="ts", seq=["event_id"], entity="clients_csv",
                     max_files_per_trigger=2)
    q.awaitTermination()
    return SN.read_table(spark, root, "clients")


@register("stream_merge_hwm", """
SELECT 'clients_csv' AS entity, 'ALL' AS branch_id, max(ts) AS last_updated FROM events""")
def stream_merge_hwm(spark, sf):
    ev = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.col("value").cast("string").alias("value"), "props", F.col("user_id").alias("_k"))
    landing = scratch_path(spark, "landing")
    ev.repartition(4, "_k").drop("_k").write.option("header", True).option("quote", '"').option(
        "escape", '"').option("emptyValue", "").csv(landing)
    root = scratch_path(spark, "hub")
    q = stream_merge(spark, landing, EVENTS_FEED, root, scratch_path(spark, "stream-ckpt"), table="clients",
                     keys=["user_id", "event_type"], version="ts", seq=["event_id"], entity="clients_csv",
                     max_files_per_trigger=1)
    q.awaitTermination()
    return SN.read_table(spark, root, "hwm").select("entity", "branch_id", "last_updated")


# ================================================================ K5 HWM table upgrade
@register("hwm_upgrade", f"""
SELECT 'transactions_csv' AS entity, CAST(l_suppkey AS VARCHAR) AS branch_id, max(l_shipdate) AS last_updated,
       {date_lit(RUN_1)} AS created_at, {date_lit(RUN_1)} AS updated_at FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT 'clients_csv', 'ALL', max(ts), {date_lit(RUN_1)}, {date_lit(RUN_1)} FROM events""")
def hwm_upgrade(spark, sf):
    """Marks stored in the old layout (source_name, last_updated_at, blank
    branch for entity-wide marks) upgraded to the current one."""
    li = table(spark, sf, "lineitem")
    ev = table(spark, sf, "events")
    old = (li.groupBy("l_suppkey").agg(F.max("l_shipdate").alias("last_updated_at"))
             .select(F.lit("transactions_csv").alias("source_name"), F.col("l_suppkey").cast("string").alias("branch_id"),
                     "last_updated_at")
             .unionByName(ev.agg(F.max("ts").alias("last_updated_at"))
                            .select(F.lit("clients_csv").alias("source_name"), F.lit(None).cast("string").alias("branch_id"),
                                    "last_updated_at"))
             .withColumn("created_at", F.lit(RUN_1)).withColumn("updated_at", F.lit(RUN_1)))
    return H.upgrade_hwm(old)


@register("latest_by_file_order", """
SELECT transaction_id, version FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id, l_shipdate AS version,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST, l_linenumber, l_partkey,
                            l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn__
  FROM lineitem) x WHERE rn__ = 1""")
def latest_by_file_order(spark, sf):
    """Newest header per transaction with the sequential-file tie rule (A1, W6):
    rows are ordered into 'files' and 'rows' by the remaining columns."""
    li = table(spark, sf, "lineitem")
    rows = li.select(F.col("l_orderkey").cast("string").alias("transaction_id"), F.col("l_shipdate").alias("version"),
                     F.col("l_linenumber").alias("_file"),
                     F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                              "l_returnflag", "l_linestatus").alias("_row"))
    return L.latest_by_key(rows, ["transaction_id"], order=L.file_order("version", "_file", "_row")).select(
        "transaction_id", "version")


# ================================================================ K3 touched-bucket merge
_LATE_CUT = "2001-10-15 00:00:00"
_S_LATE = ("(" + latest_sql(f"(SELECT * FROM lineitem WHERE {LI_VERSION} >= TIMESTAMP '{_LATE_CUT}')",
                            LI_KEY, order_sql(LI_VERSION, LI_TIEBREAK), LI_COLS) + ")")


@register("merge_touched_buckets", merge_sql(_T_ITEMS, _S_LATE, LI_KEY, LI_COLS + ["created_at", "updated_at"], "newer",
                                             LI_VERSION, created="created_at", updated="updated_at",
                                             run_ts=date_lit(RUN_2)))
def merge_touched_buckets(spark, sf):
    """Items stored in 256 key buckets; a late batch rewrites only the buckets
    it touches, the manifest keeps every other bucket's files."""
    root = scratch_path(spark, "hub")
    SN.publish_bucketed(spark, root, "20240101000000", "items", _items_target(spark, sf), LI_KEY, buckets=256)
    late = L.latest_by_key(table(spark, sf, "lineitem").where(F.col(LI_VERSION) >= ntz(_LATE_CUT)), LI_KEY,
                           LI_VERSION, LI_TIEBREAK)

    def upsert(target, source):
        return M.merge(target, source, LI_KEY, "newer", LI_VERSION, created_col="created_at",
                       updated_col="updated_at", run_ts=RUN_2)

    SN.merge_into(spark, root, "20240201000000", "items", late, upsert)
    return SN.read_table(spark, root, "items")


# ================================================================ S7/S8 -> T8 refresh from envelopes
@register("staff_from_pages", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS staff_id, CAST(s_nationkey AS VARCHAR) AS branch_id, s_name AS first_name,
       '' AS last_name, FALSE AS archived, CAST(NULL AS DATE) AS birth_date,
       {date_lit(RUN_2)} AS created_at, {date_lit(RUN_2)} AS updated_at
FROM supplier""")
def staff_from_pages(spark, sf):
    """Suppliers landed as staff envelopes per branch (nation), read back and
    fully refreshed into an empty staff table."""
    sup = table(spark, sf, "supplier")
    rows = sup.select(F.col("s_nationkey").cast("string").alias("branch_id"), F.lit(0).cast("long").alias("page"),
                      F.col("s_suppkey").alias("pos"), F.col("s_suppkey").cast("string").alias("staff_id"),
                      F.col("s_name").alias("first_name"))
    root = scratch_path(spark, "staff-pages")
    PG.write_pages(rows, root, "staff", page_size=200)
    got, _ = PG.read_pages(spark, root, "staff")
    got = PG.parse_item_times(got, "staff")
    target = got.select("staff_id", "branch_id", "first_name", "last_name", "archived", "birth_date",
                        F.lit(RUN_1).alias("created_at"), F.lit(RUN_1).alias("updated_at")).limit(0)
    from .jobs import refresh_job
    out = refresh_job(got, target, ["staff_id", "branch_id"], H.empty_hwm(spark, "timestamp", "date"),
                      "staff_api", RUN_2)
    return out["table"]


@register("branches_from_pages", f"""
SELECT CAST(n_nationkey AS VARCHAR) AS branch_id, n_name AS name, CAST(NULL AS DOUBLE) AS latitude,
       CAST(NULL AS BIGINT) AS account_id, CAST(n_regionkey AS VARCHAR) AS city,
       {date_lit(RUN_2)} AS created_at, {date_lit(RUN_2)} AS updated_at
FROM nation""")
def branches_from_pages(spark, sf):
    """Nations landed as one branches envelope, read back and upserted."""
    nat = table(spark, sf, "nation")
    rows = nat.select(F.lit("ALL").alias("landing_branch"), F.lit(0).cast("long").alias("page"),
                      F.col("n_nationkey").cast("long").alias("pos"),
                      F.col("n_nationkey").cast("string").alias("branch_id"), F.col("n_name").alias("name"),
                      F.col("n_regionkey").cast("string").alias("city"))
    root = scratch_path(spark, "branch-pages")
    PG.write_pages(rows, root, "branches", page_size=200)
    got, _ = PG.read_pages(spark, root, "branches")
    got = got.select("branch_id", "name", "latitude", "account_id", "city")
    target = got.select(*got.columns, F.lit(RUN_1).alias("created_at"), F.lit(RUN_1).alias("updated_at")).limit(0)
    return M.merge(target, got, ["branch_id"], "always", created_col="created_at", updated_col="updated_at",
                   run_ts=RUN_2)


# ================================================================ S10/S11 -> T7 products from envelopes
_PF_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"] + LI_TIEBREAK


def _land_product_pages(spark, sf, files=None):
    """Lineitem observations landed as product pages: 100 per page per
    supplier branch, feed order = ship date (then every other column). There are as many
    branches as suppliers, so pages name their branch and share files."""
    from ..operators.pages import assign_pages
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    obs = li.join(part, li.l_partkey == part.p_partkey, "inner").select(
        F.col("l_suppkey").cast("string").alias("branch_id"), F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("brand_name"), F.col("p_type").alias("type"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity_in_stock"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), *_PF_ORDER)
    paged = assign_pages(obs, "branch_id", [F.col(c).asc_nulls_first() for c in _PF_ORDER],
                         page_size=100)
    root = scratch_path(spark, "product-pages")
    PG.write_pages(paged, root, "products", page_size=100, by_folder=False, files=files)
    return root


def _stock_out(stock):
    return stock.select("product_id", "branch_id", "price", "quantity_in_stock",
                        F.unix_micros("updated_at_ph").alias("updated_us"), "last_synced_at")


@register("products_from_pages", f"""
SELECT product_id, branch_id, price, quantity_in_stock, updated_us, {date_lit(RUN_2)} AS last_synced_at FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS branch_id,
         CASE WHEN l_extendedprice <> 0 THEN l_extendedprice END AS price, l_quantity AS quantity_in_stock,
         epoch_us(l_shipdate) AS updated_us,
         row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {', '.join(c + ' DESC' for c in _PF_ORDER)}) AS rn__
  FROM lineitem JOIN part ON l_partkey = p_partkey) x WHERE rn__ = 1""")
def products_from_pages(spark, sf):
    """Observations landed as product pages (100 per page, per supplier
    branch, feed order = ship date), read back and synced into an empty stock
    table: last row per (product, branch) in page order wins."""
    from .jobs import products_job
    rows, _ = PG.read_pages(spark, _land_product_pages(spark, sf), "products")
    feed = (PG.parse_item_times(rows, "products")
            .withColumnRenamed("type", "type_raw").withColumnRenamed("updated_at", "updated_at_ph"))
    stock0 = spark.createDataFrame([], "product_id string, branch_id string, price double, quantity_in_stock double, "
                                       "updated_at_ph timestamp, last_synced_at date")
    master0 = spark.createDataFrame([], "id string, name string, inserted_at date, updated_at date")
    out = products_job(feed, master0, stock0, H.empty_hwm(spark, "timestamp", "date"), ["page", "pos"], RUN_2,
                       outputs=("stock",))
    return _stock_out(out["stock"])


# ================================================================ S12 full sync, W3 latest-N from envelopes
_RV_STORED_SQL = f"""(SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS branch_id,
    CAST(user_id AS VARCHAR) AS client_id, CAST(ts AS DATE) AS review_date, props AS text,
    {date_lit(RUN_1)} AS created_at FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')"""


def _landed_reviews(spark, sf, page_size):
    """Events landed as review pages (newest first, ``page_size`` per page) and read back."""
    from ..operators.pages import assign_pages
    ev = table(spark, sf, "events")
    rows = ev.select(F.col("event_type").alias("branch_id"), F.col("event_id").alias("_id"), "ts",
                     F.col("event_id").cast("string").alias("review_id"),
                     F.col("user_id").cast("string").alias("client_id"),
                     F.date_format("ts", "yyyy-MM-dd").alias("review_date"), F.col("props").alias("text"))
    rows = assign_pages(rows, "branch_id", [F.col("ts").desc(), F.col("_id").desc()],
                        page_size=page_size).drop("_id", "ts")
    root = scratch_path(spark, "review-pages")
    PG.write_pages(rows, root, "reviews", page_size=page_size)
    got, pages = PG.read_pages(spark, root, "reviews")
    return PG.parse_item_times(got, "reviews"), pages


def _stored_reviews_text(spark, sf):
    from .q_flows import stored_reviews
    return stored_reviews(spark, sf).select(F.col("review_id").cast("string").alias("review_id"), "branch_id",
                                            F.col("client_id").cast("string").alias("client_id"), "review_date",
                                            "text", "created_at")


@register("reviews_full_sync", f"""
SELECT * FROM {_RV_STORED_SQL} t
UNION ALL
SELECT CAST(event_id AS VARCHAR), event_type, CAST(user_id AS VARCHAR), CAST(ts AS DATE), props, {date_lit(RUN_2)}
FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'""")
def reviews_full_sync(spark, sf):
    """All landed pages (200 per page) inserted if absent into the stored reviews."""
    from .jobs import reviews_full_sync as full_sync
    rows, pages = _landed_reviews(spark, sf, 200)
    return full_sync(rows, pages, _stored_reviews_text(spark, sf), RUN_2)


@register("latest_reviews", f"""
SELECT * FROM {_RV_STORED_SQL} t
UNION ALL
SELECT CAST(event_id AS VARCHAR), event_type, CAST(user_id AS VARCHAR), CAST(ts AS DATE), props, {date_lit(RUN_2)}
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn__ FROM events) x
WHERE rn__ <= 10 AND ts >= TIMESTAMP '2024-01-20 00:00:00'""")
def latest_reviews_q(spark, sf):
    """The latest 10 reviews per branch (first rows of the feed) inserted if absent."""
    from .jobs import latest_reviews
    rows, _ = _landed_reviews(spark, sf, 200)
    return latest_reviews(rows, _stored_reviews_text(spark, sf), RUN_2, n=10)



@register("products_stream_pages", f"""
SELECT product_id, branch_id, price, quantity_in_stock, updated_us, {date_lit(RUN_2)} AS last_synced_at FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS branch_id,
         CASE WHEN l_extendedprice <> 0 THEN l_extendedprice END AS price, l_quantity AS quantity_in_stock,
         epoch_us(l_shipdate) AS updated_us,
         row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {', '.join(c + ' DESC' for c in _PF_ORDER)}) AS rn__
  FROM lineitem JOIN part ON l_partkey = p_partkey) x WHERE rn__ = 1""")
def products_stream_pages(spark, sf):
    """The same landed product pages drained by the page stream (several
    micro-batches, each upserted by touched buckets with its history seeded
    from the stock the previous batch published)."""
    from ..streaming.stream import products_stream
    root = _land_product_pages(spark, sf, files=1000)
    hub = scratch_path(spark, "hub")
    products_stream(spark, root, hub, scratch_path(spark, "stream-ckpt"), RUN_2,
                    max_files_per_trigger=400).awaitTermination()
    return _stock_out(SN.read_table(spark, hub, "product_stock"))
