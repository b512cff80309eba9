"""A9/W2/U1/A7 paged overlap and W1 change history, incl. the hot-group split path."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import history as HI
from tidemark.operators import pages as P
from tidemark.operators import sequence as SQ


def test_overlap_stop_rule(spark):
    # page dup ratios .2,.95,.5,.9,1,.95,0 -> pages 0-5 kept
    ratios = [0.2, 0.95, 0.5, 0.9, 1.0, 0.95, 0.0]
    stats = spark.createDataFrame([("b", i, r) for i, r in enumerate(ratios)], "branch_id string, page long, dup_ratio double")
    kept = sorted(r.page for r in P.early_stop(stats).collect())
    assert kept == [0, 1, 2, 3, 4, 5]
    # no streak -> everything kept
    stats2 = spark.createDataFrame([("b", i, r) for i, r in enumerate([0.9, 0.95, 0.1, 1.0])],
                                   "branch_id string, page long, dup_ratio double")
    assert sorted(r.page for r in P.early_stop(stats2).collect()) == [0, 1, 2, 3]


def test_page_overlap_counts_earlier_pages(spark):
    rows = spark.createDataFrame([("b", 0, "r1"), ("b", 0, "r2"), ("b", 1, "r2"), ("b", 1, "r3"), ("b", 1, "r3")],
                                 "branch_id string, page long, review_id string")
    known = spark.createDataFrame([("b", "r3")], "branch_id string, review_id string")
    out = {r.page: (r.n_rows, r.n_known, r.dup_ratio) for r in P.page_overlap(rows, known).collect()}
    assert out == {0: (2, 0, 0.0), 1: (3, 2, 2 / 3)}


def test_latest_n_default(spark):
    df = spark.range(30).select((F.col("id") % 2).alias("g"), F.col("id"))
    out = P.latest_n(df, ["g"], [F.col("id").desc()], n=0).collect()
    assert len(out) == 20 and max(r.rank_no for r in out) == 10


def test_position_split_equals_window(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1000).alias("o"), "id")
    a = SQ.position_within(df, ["g"], [F.col("o").desc(), F.col("id")], ranges=8)
    w = Window.partitionBy("g").orderBy(F.col("o").desc(), "id")
    b = df.withColumn("pos", F.row_number().over(w) - 1)
    assert sorted(map(tuple, a.select("g", "id", "pos").collect())) == sorted(map(tuple, b.select("g", "id", "pos").collect()))


def test_change_history_rules(spark):
    # first sight -> row; qty same, price changed -> none; qty changed -> row
    obs = spark.createDataFrame([
        ("p1", "b", 1, 5.0, 10.0), ("p1", "b", 2, 5.0, 11.0), ("p1", "b", 3, 4.0, 11.0),
        ("p2", "b", 1, 7.0, 1.0), ("p2", "b", 2, None, 1.0), ("p2", "b", 3, None, 1.0)],
        "product_id string, branch_id string, seq int, quantity_in_stock double, price double")
    current = spark.createDataFrame([("p2", "b", 7.0)], "product_id string, branch_id string, quantity_in_stock double")
    for opts in ({}, {"ranges": 2}):
        h = HI.change_history(obs, current, ["product_id", "branch_id"], "quantity_in_stock", ["seq"],
                              carry=["price"], run_ts=dt.date(2024, 1, 1), **opts)
        got = sorted((r.product_id, r.quantity_in_stock, r.price) for r in h.collect())
        assert got == sorted([("p1", 5.0, 10.0), ("p1", 4.0, 11.0), ("p2", None, 1.0)]), opts
    replay = HI.replay_state(h.withColumn("seq", F.lit(1)), ["product_id"], "quantity_in_stock", ["snapshot_time"])
    assert replay.count() == 2


def test_valid_pages_stop_vs_skip(spark):
    pages = spark.createDataFrame([("b", 0, 2, 4), ("b", 1, 0, 4), ("b", 2, 3, 4), ("b", 3, 1, 4), ("b", 4, 1, 4)],
                                  "branch_id string, page long, n_rows long, total_pages long")
    assert sorted(r.page for r in P.valid_pages(pages).collect()) == [0]
    assert sorted(r.page for r in P.valid_pages(pages, on_empty="skip").collect()) == [0, 2, 3]


def test_rows_of_valid_pages(spark):
    pages = spark.createDataFrame([("b", 0, 2, 5), ("b", 1, 0, 5), ("b", 2, 1, 5), ("c", 0, 1, 1), ("c", 1, 1, 1)],
                                  "branch_id string, page long, n_rows long, total_pages long")
    rows = spark.createDataFrame([("b", 0, "x"), ("b", 0, "y"), ("b", 2, "z"), ("c", 0, "u"), ("c", 1, "v")],
                                 "branch_id string, page long, id string")
    got = sorted(r.id for r in P.rows_of_valid_pages(rows, pages).collect())
    assert got == ["u", "x", "y"]  # b stops at its empty page 1; c's page 1 is beyond totalPages


def test_equal_lead_spreads_over_ranges(spark):
    """One key whose rows share one leading value (or have none) still fills many ranges."""
    for lead in (F.lit(1), F.lit(None).cast("int")):
        df = spark.range(4000).select(F.lit("k").alias("g"), lead.alias("o"), "id")
        sizes = SQ.ranged(df, ["g"], ["o", "id"], 16).groupBy("_range").count().collect()
        assert len(sizes) == 16 and max(r["count"] for r in sizes) < 1000
        out = SQ.with_previous(df, ["g"], ["o", "id"], ["id"], ranges=16).collect()
        assert all(r.prev_id == (r.id - 1 if r.id else None) and r.has_prev == (r.id > 0) for r in out)
