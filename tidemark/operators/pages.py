"""Paged feeds: page overlap (A9), early stop on overlap (W2), latest-N (W3),
archive of pages with new rows (U1) and the mark they advance (A7, A8).

A page is identified by ``(branch, page)``; ``pos`` is the row's place on the
page. Everything is a join or an aggregate on ``(branch, page)`` or
``(branch, id)`` -- both near-unique -- so no branch is ever processed by a
single task. The consecutive-page streak is computed with two equi-joins on
``page - 1`` and ``page - 2`` instead of a running window over a branch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .joins import join_small
from .sequence import position_within

# Fixed values of the overlap rule.
NEAR_DUP_RATIO = 0.9
NEAR_DUP_STREAK = 3
DEFAULT_PAGE_SIZE = 100
DEFAULT_LATEST_N = 10


def assign_pages(df: DataFrame, branch: str, order: Sequence[Column], page_size: int = DEFAULT_PAGE_SIZE,
                 ranges: int | None = None) -> DataFrame:
    """Number rows per branch in feed order and cut them into pages."""
    d = position_within(df, [branch], order, out="_pos", ranges=ranges)
    return (d.withColumn("page", F.floor(F.col("_pos") / page_size).cast("long"))
             .withColumn("pos", (F.col("_pos") % page_size).cast("long"))
             .drop("_pos"))


def page_overlap(pages: DataFrame, known: DataFrame, branch: str = "branch_id", page: str = "page",
                 id_col: str = "review_id", materialize: bool = True) -> DataFrame:
    """Per page: rows, distinct ids already stored, and ``dup_ratio``.

    An id counts as stored when ``known`` has it for the same branch or when it
    was on an earlier page of the same branch (earlier pages are stored before
    the next one is checked). The result (one row per page) feeds the stop
    rule several times, so by default it is checkpointed to the reliable
    checkpoint folder once instead of being recomputed by every consumer.
    """
    own = pages.select(branch, page, id_col)
    seen = own.withColumn("_stored", F.lit(False)).unionByName(
        known.select(branch, id_col).withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    # one aggregate tells an id's first page and whether it is stored
    seen = seen.groupBy(branch, id_col).agg(F.min(page).alias("_first_page"), F.max("_stored").alias("_stored"))
    j = own.join(seen, on=[branch, id_col], how="inner")
    is_known = F.col("_stored") | (F.col("_first_page") < F.col(page))
    stats = (j.groupBy(branch, page)
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_distinct(F.when(is_known, F.col(id_col))).alias("n_known")))
    stats = stats.withColumn("dup_ratio", F.col("n_known") / F.col("n_rows"))
    return reliable_checkpoint(stats) if materialize else stats


def overlap_cut(stats: DataFrame, branch: str = "branch_id", page: str = "page",
                ratio: float = NEAR_DUP_RATIO, streak: int = NEAR_DUP_STREAK) -> DataFrame:
    """First page per branch that completes ``streak`` consecutive near-duplicate
    pages (``dup_ratio >= ratio``); branches without such a run get no row."""
    near = stats.where(F.col("dup_ratio") >= ratio).select(branch, page)
    run = near
    for k in range(1, streak):
        prev = near.select(F.col(branch), (F.col(page) + k).alias(page))
        run = run.join(prev, on=[branch, page], how="left_semi")
    return run.groupBy(branch).agg(F.min(page).alias("cut_page"))


def early_stop(stats: DataFrame, branch: str = "branch_id", page: str = "page",
               ratio: float = NEAR_DUP_RATIO, streak: int = NEAR_DUP_STREAK) -> DataFrame:
    """Pages processed before the stop: every page up to and including the cut,
    or all pages of a branch that never reaches the streak."""
    cut = overlap_cut(stats, branch, page, ratio, streak)
    j = join_small(stats, cut, on=branch, how="left")  # one row per branch
    return j.where(F.col("cut_page").isNull() | (F.col(page) <= F.col("cut_page"))).drop("cut_page")


def valid_pages(pages: DataFrame, branch: str = "branch_id", page: str = "page",
                total_pages: str | None = "total_pages", on_empty: str = "stop") -> DataFrame:
    """Pages a sequential pager would process: pages below ``totalPages``
    (when known) that hold rows; ``on_empty='stop'`` also drops everything
    after a branch's first empty page (products), ``'skip'`` just skips the
    empty page and continues (full reviews sync).

    ``pages`` has one row per page (``n_rows`` may be 0 for an empty page).
    """
    cond = F.col("n_rows") > 0
    if total_pages:
        tp = F.coalesce(F.col(total_pages), F.lit(0))
        cond = cond & ((tp <= 0) | (F.col(page) < tp))
    if on_empty == "skip":
        return pages.where(cond)
    empty = pages.where(F.col("n_rows") == 0).groupBy(branch).agg(F.min(page).alias("_first_empty"))
    j = join_small(pages, empty, on=branch, how="left")  # one row per branch
    cond = cond & (F.col("_first_empty").isNull() | (F.col(page) < F.col("_first_empty")))
    return j.where(cond).drop("_first_empty")


def rows_of_valid_pages(rows: DataFrame, pages: DataFrame, branch: str = "branch_id", page: str = "page",
                        on_empty: str = "stop") -> DataFrame:
    """Rows of the pages a sequential pager would have fetched (see
    :func:`valid_pages`); a semi-join on ``(branch, page)``."""
    ok = valid_pages(pages, branch, page, on_empty=on_empty).select(branch, page)
    return rows.join(ok, on=[branch, page], how="left_semi")


def pages_with_new_rows(rows: DataFrame, kept: DataFrame, branch: str = "branch_id",
                        page: str = "page") -> DataFrame:
    """Rows of kept pages with at least one new row (``dup_ratio < 1``) --
    the archive set; duplicates on those pages are included."""
    fresh = kept.where(F.col("dup_ratio") < 1.0).select(branch, page)
    return rows.join(fresh, on=[branch, page], how="left_semi")


def new_page_mark(archive: DataFrame, branch: str = "branch_id", date_col: str = "review_date") -> DataFrame:
    """Max review day of the archive set per branch (the next mark)."""
    return (archive.where(F.col(date_col).isNotNull())
                   .groupBy(branch).agg(F.max(date_col).alias("last_review_date")))


def max_date_by_branch(df: DataFrame, branch: str = "branch_id", date_col: str = "review_date") -> DataFrame:
    """``MAX(review_date)::text`` per branch."""
    return df.groupBy(branch).agg(F.max(date_col).cast("string").alias("max_review_date"))


def latest_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = DEFAULT_LATEST_N,
             rank_col: str = "rank_no") -> DataFrame:
    """Top ``n`` rows per group (``n <= 0`` means the default 10).

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit`` that
    keeps at most ``n`` rows per group in every input partition before the
    shuffle, so a hot group costs ``n`` rows per partition, not its size.
    """
    n = n if n > 0 else DEFAULT_LATEST_N
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
