"""Incremental jobs composed from the operators.

Each job is a function of DataFrames returning DataFrames (the new table
versions); nothing is written here. Branch is a column everywhere -- one plan
covers all branches instead of a loop per branch. Persisting the outputs
together is :func:`tidemark.sources.snapshots.publish`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank_to_null, zero_to_null
from ..operators import history as HI
from ..operators import latest as L
from ..operators import merge as M
from ..operators import pages as P
from ..operators import watermarks as H
from ..operators.filters import drop_blank, product_type_filter
from ..session import scratch_path
from ..sources import specs

# Key buckets of the large tables written by the imports (copy-on-write unit);
# size it so one bucket holds ~1 GB at the target volume.
DEFAULT_BUCKETS = 64

# ----------------------------------------------------------------- products
# Product fields that turn '' into NULL (``name`` keeps '').
PRODUCT_BLANK_TO_NULL = ["parent_id", "brand_id", "brand_name", "category_id", "category_name", "code",
                         "type_raw", "measurement_unit"]
# Numeric fields where 0 means "not set" (quantity in stock keeps 0).
PRODUCT_ZERO_TO_NULL = ["price", "min_quantity", "max_quantity", "reorder_count", "reorder_cost",
                        "measurement_qty"]
MASTER_COLS = ["id", "parent_id", "name", "brand_id", "brand_name", "category_id", "category_name", "code",
               "type_raw", "measurement_qty", "measurement_unit", "archived", "created_at_ph", "updated_at_ph"]
STOCK_COLS = ["product_id", "branch_id", "price", "min_quantity", "max_quantity", "quantity_in_stock",
              "reorder_count", "reorder_cost", "archived", "created_at_ph", "updated_at_ph"]
_DOUBLES = {"measurement_qty", "price", "min_quantity", "max_quantity", "quantity_in_stock", "reorder_count",
            "reorder_cost"}


def _ddl(columns: Sequence[str]) -> str:
    kind = lambda c: ("double" if c in _DOUBLES else "boolean" if c == "archived"
                      else "timestamp" if c.endswith("_at_ph") else "string")
    return ", ".join(f"{c} {kind(c)}" for c in columns)


# The stored product tables: every field of the feed, the feed order of the row that wrote
# it (``feed_seq``: compared field by field, whatever a branch id holds) and audit columns.
MASTER_DDL = _ddl(MASTER_COLS) + ", feed_seq struct<sync: string, branch_id: string, place: bigint>, inserted_at date, updated_at date"
STOCK_DDL = _ddl(STOCK_COLS) + ", feed_seq struct<sync: string, place: bigint>, last_synced_at date"

# How batches change the stored tables.
ITEM_RULE = M.MergeRule(("transaction_item_id",), "newer", "source_updated_at", ("transaction_id", *specs.ITEM_INSERT_ONLY),
                        "created_at", "updated_at")
HEADER_RULE = M.MergeRule(("transaction_id",), "newer", "source_updated_at", (), "created_at", "updated_at")
CLIENT_RULE = M.MergeRule(("client_id",), "newer", "source_updated_at", (), "created_at", "updated_at")
# Every item names its header.
ITEM_HEADER = ("transaction_items", "transactions", (("transaction_id", "transaction_id"),))


def product_rows(obs: DataFrame) -> DataFrame:
    """Apply the product NULL rules (P9/P10) to observation columns present."""
    out = obs
    for c in PRODUCT_BLANK_TO_NULL:
        if c in obs.columns:
            out = out.withColumn(c, blank_to_null(c))
    for c in PRODUCT_ZERO_TO_NULL:
        if c in obs.columns:
            out = out.withColumn(c, zero_to_null(c))
    if "quantity_in_stock" in obs.columns:
        out = out.withColumn("quantity_in_stock", F.coalesce(F.col("quantity_in_stock"), F.lit(0.0)))
    return out


def products_job(obs: DataFrame, master: DataFrame, stock: DataFrame, hwm: DataFrame,
                 seq: Sequence[str], run_ts, product_type: str | None = None, now=None,
                 updated_col: str = "updated_at_ph", type_col: str = "type_raw",
                 branch_order: Sequence[Column] | None = None, entity: str = "products_api",
                 outputs: Sequence[str] = ("master", "stock", "history", "hwm"), window: bool = True,
                 history_ts=None, history_carry: Sequence[str] = ("price",)) -> dict:
    """Products sync for all branches in one plan.

    ``obs`` holds one row per fetched product and branch (``id``/``product_id``
    naming follows the master/stock tables) plus the ``seq`` columns giving the
    feed order within a branch. Returns ``master``, ``stock``, ``history`` and
    ``hwm`` (new versions).

    * I4 type filter and I3 window (``hwm < updated <= now`` when both bounds
      exist) restrict the feed;
    * J6 master: when branches disagree the last processed branch wins
      (``branch_order``, default branch id ascending, then feed order);
      ``inserted_at`` is insert-only;
    * J7 stock: last row per (product, branch) overwrites;
    * W1 history from the stored stock as seed; A6 mark = max ``updated``.

    ``window=False`` leaves I3 out: the pages of one sync are all part of it, even when
    they come in several batches and an earlier one has moved the mark. Where the stored
    tables have ``feed_seq`` (and the feed too), a row from earlier in a feed never
    replaces one from later on. ``history_ts`` stamps the history (default ``run_ts``).

    ``outputs`` limits which tables are planned (the history runs a bounded
    hot-group check when planned). ``master_upsert`` / ``stock_upsert`` give
    ``(keys, batch, merge_fn)`` for bucketed copy-on-write storage.
    """
    feed = product_type_filter(obs, type_col, product_type)
    if window:
        feed = H.incremental_window(feed, hwm, updated_col, "between", now=now, on="branch_id", entity=entity)
    feed = product_rows(feed)
    out = {}
    if "master" in outputs:
        border = list(branch_order) if branch_order is not None else [F.col("branch_id").desc_nulls_last()]
        last_first = border + [F.col(s).desc_nulls_last() for s in seq]
        master_src = L.latest_by_key(feed.withColumn("id", F.col("product_id")), ["id"], order=last_first)
        if "feed_seq" in master_src.columns:  # branches are processed in order of their ids
            master_src = master_src.withColumn("feed_seq", F.struct(F.col("feed_seq.sync").alias("sync"), F.col("branch_id").cast("string").alias("branch_id"),
                                                                    F.col("feed_seq.place").alias("place")))
        master_src = master_src.select(*[c for c in master.columns if c in master_src.columns])

        def master_merge(target, source):
            guard = ("newer", "feed_seq") if "feed_seq" in target.columns else ("always", None)
            return M.merge(target, source, ["id"], *guard, insert_only=["inserted_at"], created_col="inserted_at",
                           updated_col="updated_at", run_ts=run_ts)

        out["master"] = master_merge(master, master_src)
        out["master_upsert"] = (["id"], master_src, master_merge)
    if "stock" in outputs:
        stock_src = L.latest_by_key(feed, ["product_id", "branch_id"], order=[F.col(s).desc_nulls_last() for s in seq])
        stock_src = stock_src.select(*[c for c in stock.columns if c in stock_src.columns])

        def stock_merge(target, source):
            guard = ("newer", "feed_seq") if "feed_seq" in target.columns else ("always", None)
            return M.merge(target, source, ["product_id", "branch_id"], *guard, updated_col="last_synced_at",
                           run_ts=run_ts)

        out["stock"] = stock_merge(stock, stock_src)
        out["stock_upsert"] = (["product_id", "branch_id"], stock_src, stock_merge)
    if "history" in outputs:
        out["history"] = HI.change_history(feed, stock, ["product_id", "branch_id"], "quantity_in_stock", seq,
                                           carry=list(history_carry),
                                           run_ts=run_ts if history_ts is None else history_ts)
    if "hwm" in outputs:
        out["hwm"] = H.merge_hwm(hwm, H.seed_hwm(feed, entity, updated_col, branch="branch_id"), run_ts)
    return out


# ----------------------------------------------------------------- reviews
def reviews_job(rows: DataFrame, reviews: DataFrame, hwm: DataFrame, run_ts,
                id_col: str = "review_id", branch: str = "branch_id",
                date_col: str = "review_date", entity: str = "reviews_api") -> dict:
    """Incremental reviews over landed pages of every branch.

    ``rows`` carries ``branch_id, page, pos`` and the review columns. Pages
    are checked against the stored reviews (A9), processing stops after the
    overlap streak (W2), every processed page is inserted if absent (J8,
    first occurrence by page/pos wins), pages with a new row form the archive
    (U1) and advance the mark to their max review day (A7).
    """
    rows = drop_blank(rows, [id_col, branch])
    stats = P.page_overlap(rows, reviews, branch, "page", id_col)
    kept = P.early_stop(stats, branch, "page")
    processed = rows.join(kept.select(branch, "page"), on=[branch, "page"], how="left_semi")
    batch = L.first_by_key(processed, [id_col], [branch, "page", "pos"]).select(
        *[c for c in reviews.columns if c in processed.columns])

    def reviews_merge(target, source):
        return M.merge(target, source, [id_col], "absent",
                       created_col="created_at" if "created_at" in reviews.columns else None, run_ts=run_ts)

    new_reviews = reviews_merge(reviews, batch)
    archive = P.pages_with_new_rows(rows, kept, branch, "page")
    mark = P.new_page_mark(archive, branch, date_col)
    cand = mark.select(F.lit(entity).alias("entity"), F.col(branch).alias("branch_id"),
                       F.col("last_review_date").cast("timestamp").alias("last_updated"))
    return {"stats": stats, "kept": kept, "reviews": new_reviews, "archive": archive, "mark": mark,
            "hwm": H.merge_hwm(hwm, cand, run_ts), "reviews_upsert": ([id_col], batch, reviews_merge)}


def reviews_full_sync(rows: DataFrame, pages: DataFrame, reviews: DataFrame, run_ts,
                      id_col: str = "review_id", branch: str = "branch_id") -> DataFrame:
    """Full reviews sync: every page below ``totalPages`` (empty pages
    skipped) inserted if absent (J8, first occurrence by page/pos wins)."""
    ok = P.valid_pages(pages, branch, "page", on_empty="skip").select(branch, "page")
    rows = drop_blank(rows, [id_col, branch]).join(ok, on=[branch, "page"], how="left_semi")
    return M.merge(reviews, rows.select(*[c for c in reviews.columns if c in rows.columns], "page", "pos"),
                   [id_col], "absent", dedup=True, seq=[branch, "page", "pos"],
                   created_col="created_at" if "created_at" in reviews.columns else None, run_ts=run_ts)


def latest_reviews(rows: DataFrame, reviews: DataFrame, run_ts, n: int = 10, id_col: str = "review_id",
                   branch: str = "branch_id") -> DataFrame:
    """Latest-N per branch (W3: the first ``n`` rows of the feed, ``n <= 0``
    means 10) inserted if absent (J8)."""
    top = P.latest_n(drop_blank(rows, [id_col, branch]), [branch],
                     [F.col("page").asc(), F.col("pos").asc()], n, rank_col="_rank")
    return M.merge(reviews, top.select(*[c for c in reviews.columns if c in top.columns], "page", "pos"),
                   [id_col], "absent", dedup=True, seq=[branch, "page", "pos"],
                   created_col="created_at" if "created_at" in reviews.columns else None, run_ts=run_ts)


# ----------------------------------------------------------------- staff / branches
def refresh_job(landed: DataFrame, target: DataFrame, keys: Sequence[str], hwm: DataFrame, entity: str,
                run_ts, branch: str | None = "branch_id") -> dict:
    """Full refresh: unconditional upsert of every landed row (J4/J5), rows with
    a blank branch skipped (P11), mark = run time per branch (or 'ALL'). A key
    listed twice keeps its last occurrence in feed order (``page``, ``pos``)."""
    src = drop_blank(landed, [branch]) if branch else landed
    # without a feed order the largest row by its columns stays, so that it is always the same one
    seq = [c for c in ("page", "pos") if c in src.columns] or sorted(set(src.columns) - set(keys)) or list(keys)
    table = M.merge(target, src, keys, "always", dedup=True, seq=seq,
                    created_col="created_at" if "created_at" in target.columns else None,
                    updated_col="updated_at" if "updated_at" in target.columns else None, run_ts=run_ts)
    if branch:
        cand = src.select(F.col(branch).cast("string").alias("branch_id")).distinct()
    else:
        cand = src.limit(1).select(F.lit("").alias("branch_id"))
    cand = cand.select(F.lit(entity).alias("entity"), "branch_id", F.lit(run_ts).cast("timestamp").alias("last_updated"))
    return {"table": table, "hwm": H.merge_hwm(hwm, cand, run_ts)}


# ----------------------------------------------------------------- bootstrap
def bootstrap(hwm: DataFrame, items: DataFrame, clients: DataFrame, run_ts,
              item_version: str = "source_updated_at", item_branch: str = "branch_id",
              client_version: str = "source_updated_at") -> DataFrame:
    """Seed marks from loaded data, only when neither CSV entity has one yet.

    Returns the (possibly) new HWM table: ``transactions_csv`` per branch and
    ``clients_csv`` entity-wide, merged monotonically.
    """
    if not H.needs_bootstrap(hwm, ["transactions_csv", "clients_csv"]):
        return hwm
    cand = H.seed_hwm(items, "transactions_csv", item_version, branch=item_branch).unionByName(
        H.seed_hwm(clients, "clients_csv", client_version))
    return H.merge_hwm(hwm, cand, run_ts)


# ----------------------------------------------------------------- one import batch
def import_batch(target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str, seq: Sequence,
                 hwm: DataFrame, entity: str, run_ts, insert_only: Sequence[str] = (),
                 branch: str | None = None, advance_hwm: bool = True) -> dict:
    """Latest-per-key of a batch merged newer-wins, plus the mark it advances.

    Both outputs are meant to be published together (one manifest), so the
    table and its mark never disagree. ``advance_hwm=False`` reproduces the
    transactions import that leaves marks to the bootstrap.
    """
    latest = L.latest_by_key(batch, keys, version, seq)
    table = M.merge(target, latest.select(*[c for c in target.columns if c in latest.columns]), keys, "newer",
                    version, insert_only=insert_only,
                    created_col="created_at" if "created_at" in target.columns else None,
                    updated_col="updated_at" if "updated_at" in target.columns else None, run_ts=run_ts)
    new_hwm = hwm
    if advance_hwm:
        cand = H.seed_hwm(batch, entity, version, branch=branch)
        new_hwm = H.merge_hwm(hwm, cand, run_ts)
    return {"table": table, "hwm": new_hwm}


# ----------------------------------------------------------------- CSV imports end to end
def newest_with_first_seen(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], seq: Sequence[str],
                           first_cols: Sequence[str]) -> DataFrame:
    """One row per key as a sequential import leaves it: updatable columns
    from the newest version, ``first_cols`` (insert-only) from the first row
    seen. Both picks are keyed windows with partial limits; the join is on a
    key unique on both sides."""
    keys = list(keys)
    first = L.first_by_key(rows, keys, seq).select(*keys, *first_cols)
    newest = L.latest_by_key(rows, keys, order=order).drop(*first_cols)
    return newest.join(first, on=keys, how="inner")


def _current(spark, root: str, name: str, like: DataFrame, at) -> DataFrame:
    from ..sources import snapshots as SN
    return SN.read_table(spark, root, name, at) if name in at.tables else like.limit(0)


STORAGE = ("delta", "rewrite")


def _stored(spark, root, run, at, batches: dict, run_ts, storage: str, **more) -> dict:
    """Changes tables by ``batches`` {name: (rule, source, like)}, as delta parts or by rewriting
    the buckets that they touch."""
    from ..sources import snapshots as SN
    if storage not in STORAGE:
        raise ValueError(f"storage must be one of {STORAGE}")
    if storage == "delta":
        deltas = {n: SN.Delta(rule, src, like, run_ts) for n, (rule, src, like) in batches.items()}
        return SN.upsert_tables(spark, root, run, {}, deltas=deltas, at=at, **more)
    merges = {n: (list(rule.keys), src, lambda t, s, rule=rule: rule.apply(t, s, run_ts), like)
              for n, (rule, src, like) in batches.items()}
    return SN.upsert_tables(spark, root, run, merges, at=at, **more)


def transactions_import(spark, source_dir, root: str, run: str, run_ts, advance_hwm: bool = True,
                        on_bad_file: str = "skip", strict: bool = False, window=None,
                        buckets: int = DEFAULT_BUCKETS, storage: str = "delta", on_orphan: str = "report") -> dict:
    """Transactions CSV exports -> items (J3, partial) + headers (J2) + marks,
    published together under one manifest (T12). See :func:`land_transactions`."""
    from ..sources import csv as C

    batch = C.read_csv_dir(spark, source_dir, specs.TRANSACTIONS, on_bad_file=on_bad_file)
    # items, headers, marks and references read the rows: their fields are parsed once
    typed = scratch_path(spark, "transactions")
    batch.rows.write.parquet(typed)
    touched = land_transactions(spark, spark.read.parquet(typed), root, run, run_ts, advance_hwm, strict, window, buckets, storage, on_orphan)
    return {"bad_files": batch.bad_files, "files": batch.files, "touched_buckets": touched}


def land_transactions(spark, rows: DataFrame, root: str, run: str, run_ts, advance_hwm: bool = True, strict: bool = False,
                      window=None, buckets: int = DEFAULT_BUCKETS, storage: str = "delta", on_orphan: str = "report") -> dict:
    """Parsed rows of one batch, from files or a micro-batch, into items, headers and marks.

    ``advance_hwm=False`` reproduces an import that leaves marks to the bootstrap (T5). An item id
    repeated in the batch is de-duplicated newest-wins, or fails the import
    with ``strict=True`` (J16). ``window`` (DataFrame -> DataFrame) applies
    the incremental window to the parsed rows. Tables are key-bucketed and changed by delta parts,
    or with ``storage='rewrite'`` by rewriting the buckets that the batch touches. Items without
    a header are reported, or fail the import with ``on_orphan='fail'`` (J13). Returns the
    number of buckets touched by table.
    """
    from ..sources import snapshots as SN

    at = SN.snapshot(spark, root)
    rows = rows if window is None else window(rows)
    if strict:
        L.assert_unique(rows, ["transaction_item_id"], "transactions batch")
    audit = [F.lit(run_ts).alias("created_at"), F.lit(run_ts).alias("updated_at")]
    items_like = rows.select(*specs.TRANSACTIONS.targets, *audit).limit(0)
    headers_like = rows.select(*specs.HEADER_COLUMNS, *audit).limit(0)
    seq = L.file_order("source_updated_at", "_file", "_row")
    item_src = newest_with_first_seen(rows, ["transaction_item_id"], seq, ["_file", "_row"],
                                      ("transaction_id",) + specs.ITEM_INSERT_ONLY).select(*specs.TRANSACTIONS.targets)
    head_src = L.latest_by_key(rows, ["transaction_id"], order=seq).select(*specs.HEADER_COLUMNS)
    extra = {}
    if advance_hwm:
        hwm = _current(spark, root, "hwm", H.empty_hwm(spark, "timestamp", "date"), at)
        extra["hwm"] = H.merge_hwm(hwm, H.seed_hwm(rows, "transactions_csv", "source_updated_at",
                                                   branch="branch_id"), run_ts)
    return _stored(spark, root, run, at, {"transaction_items": (ITEM_RULE, item_src, items_like),
                                          "transactions": (HEADER_RULE, head_src, headers_like)}, run_ts, storage,
                   extra=extra, buckets=buckets, refs=[SN.Reference(*ITEM_HEADER)], on_orphan=on_orphan)


def clients_import(spark, source_dir, root: str, run: str, run_ts, version_parse: str = "date",
                   on_bad_file: str = "skip", window=None, buckets: int = DEFAULT_BUCKETS, storage: str = "delta") -> dict:
    """Clients CSV exports -> clients (J1, newer wins) + entity-wide mark (A5),
    published together; a batch without any version leaves the mark alone."""
    from ..sources import csv as C
    from ..sources import snapshots as SN

    at = SN.snapshot(spark, root)
    spec = specs.clients_spec(version_parse)
    batch = C.read_csv_dir(spark, source_dir, spec, on_bad_file=on_bad_file)
    rows = batch.rows if window is None else window(batch.rows)
    like = rows.select(*spec.targets, F.lit(run_ts).alias("created_at"), F.lit(run_ts).alias("updated_at")).limit(0)
    latest = L.latest_by_key(rows, ["client_id"], order=L.file_order("source_updated_at", "_file", "_row"))
    hwm = _current(spark, root, "hwm", H.empty_hwm(spark, "timestamp", "date"), at)
    new_hwm = H.merge_hwm(hwm, H.seed_hwm(rows, "clients_csv", "source_updated_at"), run_ts)
    touched = _stored(spark, root, run, at, {"clients": (CLIENT_RULE, latest.select(*spec.targets), like)}, run_ts, storage,
                      extra={"hwm": new_hwm}, buckets=buckets)
    return {"bad_files": batch.bad_files, "files": batch.files, "touched_buckets": touched}


def reviews_bootstrap(spark, source_dir, root: str, run: str, run_ts, buckets: int = DEFAULT_BUCKETS) -> bool:
    """Seed the reviews table from archived CSVs once (T2): skipped when the
    table already has rows; the first bad file fails the load (S6)."""
    from ..sources import csv as C
    from ..sources import snapshots as SN
    from ..sources.specs import REVIEWS

    m = SN.latest_manifest(spark, root)
    if "reviews" in m and not H.is_empty(SN.read_table(spark, root, "reviews")):
        return False
    rows = C.read_csv_dir(spark, source_dir, REVIEWS, on_bad_file="fail").rows
    first = L.first_by_key(rows, ["review_id"], ["_file", "_row"]).select(*REVIEWS.targets)
    SN.publish_bucketed(spark, root, run, "reviews", first.withColumn("created_at", F.lit(run_ts)), ["review_id"],
                        buckets)
    return True
