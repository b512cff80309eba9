"""What is shuffled and copied for positions and history."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import history as HI
from tidemark.operators.sequence import position_within


def test_positions_need_no_shuffle_of_the_rows(spark):
    """Rows in order have their place; groups over many ranges, null keys and hot ones agree
    with a window."""
    df = spark.range(5000).select(F.when(F.col("id") % 7 != 0, F.col("id") % 7 % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("o"), "id")
    got = position_within(df, ["k"], [F.col("o").asc(), F.col("id").asc()], ranges=13)
    df.createOrReplaceTempView("t_growth")
    want = spark.sql("SELECT *, row_number() OVER (PARTITION BY k ORDER BY o, id) - 1 AS pos FROM t_growth")
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == 5000
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1  # over the groups, none over the rows


def test_history_copies_only_what_it_reads(spark, monkeypatch):
    """The ordered copy leaves the feed's other columns aside."""
    from tidemark.operators import sequence as SQ
    seen, ranged = [], SQ.ranged
    monkeypatch.setattr(SQ, "ranged", lambda df, *a, **k: seen.append(set(df.columns)) or ranged(df, *a, **k))
    obs = spark.range(20).select((F.col("id") % 3).alias("p"), "id", F.floor(F.col("id") / 6).alias("q"), F.lit("long text").alias("name"))
    assert HI.change_history(obs, None, ["p"], "q", ["id"], run_ts=dt.date(2024, 1, 1)).count() == 11
    assert "name" not in seen[0]


def test_rows_of_a_stream_are_not_joined_with_their_pages(spark):
    """which pages count is told from the envelopes; an undecodable one still fails the read."""
    import pytest

    from tidemark.operators.pages import rows_of_valid_pages
    from tidemark.session import scratch_path
    from tidemark.sources import pages as PG
    page = lambda n, total, ids: ('{"_embedded":{"products":[' + ",".join(f'{{"productId":"{i}"}}' for i in ids) + "]},"
                                  + f'"page":{{"number":{n},"totalPages":{total}}},"branch_id":"b{total}"}}')
    docs = [page(0, 5, "ab"), page(1, 5, ""), page(2, 5, "c"), page(0, 2, "d"), page(1, 2, "e"), page(2, 2, "f"), page(7, 0, "g")]
    root = scratch_path(spark, "t-docs")
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(root)
    read = lambda: PG._envelopes(spark.read, "products").json(root)
    rows, _ = PG.explode_pages(PG.valid_envelopes(read(), "products"), "products")
    want = rows_of_valid_pages(*PG.explode_pages(read(), "products"))
    assert sorted(r[0] for r in rows.select("product_id").collect()) == sorted(r[0] for r in want.select("product_id").collect()) == list("abdeg")
    spark.createDataFrame([('{"_embedded":{"products":[',)], "value string").write.mode("append").text(root)
    with pytest.raises(Exception, match="cannot be decoded"):
        PG.explode_pages(PG.valid_envelopes(read(), "products"), "products")[0].collect()
