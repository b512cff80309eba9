"""S1-S12, K1-K3, P4, F11/F12 edge rows: readers over hand-made files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import csv as C
from tidemark.sources import pages as PG
from tidemark.sources import sinks as K
from tidemark.sources import snapshots as SN
from tidemark.sources.specs import CLIENTS, REVIEWS, TRANSACTIONS, FeedSpec, _parse

MINI = FeedSpec("mini", _parse("""
id text
qty double0
n int0
when date
note text
"""), key=("id",), clean="runs")


def _write(root, name, data: bytes):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "wb") as f:
        f.write(data)


def test_csv_binding_quarantine_and_text_rules(spark):
    root = scratch_path(spark, "t-csv").replace("file:", "")
    _write(root, "a.csv", b"\xef\xbb\xbf Id ,QTY,n,when,note\r\n1, 12 ,1.5,2025-01-02,\"a \"\"b\"\"\nc\"\r\n,3,3,,x\r\n")
    _write(root, "b.csv", b"note,id,when,id\nz,ignored,2025-13-02,2\nw\xff\xfeq,,,3\n")  # duplicate id: last wins
    _write(root, "c.csv", b"id,qty\n9,1\n10,2,3\n")  # ragged -> whole file out
    _write(root, "d.csv", b"")  # empty file -> skipped
    _write(root, "e.txt", b"id\n99\n")  # not matched by the glob
    batch = C.read_csv_dir(spark, root, MINI)
    rows = {r.id: r for r in batch.rows.collect()}
    assert set(rows) == {"1", "2", "3"}  # blank id dropped, c.csv quarantined
    assert rows["1"].qty == 12.0 and rows["1"].n == 0 and rows["1"].when == dt.date(2025, 1, 2)
    assert rows["1"].note == 'a "b"\nc'
    assert rows["2"].qty == 0.0 and rows["2"].when is None and rows["2"].note == "z"
    assert rows["3"].note == "w?q"  # run of invalid bytes -> one '?'
    bad = [r._file for r in batch.bad_files.collect()]
    assert len(bad) == 1 and bad[0].endswith("c.csv")
    counts = {os.path.basename(r._file): (r.n_rows, r.ok) for r in C.import_counts(batch, "id").collect()}
    assert counts["a.csv"] == (1, True) and counts["c.csv"] == (0, False)
    try:
        C.read_csv_dir(spark, root, MINI, on_bad_file="fail")
        raise AssertionError("expected failure")
    except ValueError as e:
        assert "c.csv" in str(e)


def test_wide_header_restages(spark):
    root = scratch_path(spark, "t-wide").replace("file:", "")
    extra = ",".join(f"x{i}" for i in range(40))
    _write(root, "w.csv", f"id,qty,{extra}\n1,2,{','.join('v' for _ in range(40))}\n".encode())
    rows = C.read_csv_dir(spark, root, MINI).rows.collect()
    assert [(r.id, r.qty, r.note) for r in rows] == [("1", 2.0, "")]


def test_transactions_headers_and_clients(spark):
    root = scratch_path(spark, "t-tx").replace("file:", "")
    cols = [c for c, _, _ in TRANSACTIONS.columns]
    def line(vals):
        return ",".join(vals.get(c, "") for c in cols)
    body = "\n".join([",".join(cols),
                      line({"transaction_id": "t1", "transaction_item_id": "i1", "quantity": "2",
                            "purchase_time": "9:05", "purchase_updated_at": "2025-01-02T03:04:05+01:00"}),
                      line({"transaction_id": "t1", "transaction_item_id": "i2", "purchase_updated_at": ""}),
                      line({"transaction_id": "t1", "transaction_item_id": "i3",
                            "purchase_updated_at": "2025-01-02 02:04:05"})]) + "\n"
    _write(root, "tx.csv", body.encode())
    rows = C.read_csv_dir(spark, root, TRANSACTIONS).rows
    items, headers = C.items_and_headers(rows, header_cols=["transaction_id", "purchase_time", "source_updated_at"])
    assert items.count() == 3
    h = headers.collect()
    # equal versions -> the earlier row wins
    assert len(h) == 1 and h[0].purchase_time == "09:05:00.000"
    croot = scratch_path(spark, "t-cl").replace("file:", "")
    _write(croot, "c.csv", b"client_id,updated_at,credit_account_credit_limit,credit_account_credit_days,banned\n"
                           b"c1,2025-01-02T10:00:00Z,1e400,x,Y\nc2,2025-01-03,2.5,7,no\n")
    cl = {r.client_id: r for r in C.read_csv_dir(spark, croot, CLIENTS).rows.collect()}
    assert cl["c1"].source_updated_at is None and cl["c1"].credit_account_credit_limit is None
    assert cl["c1"].banned is True and cl["c2"].credit_account_credit_days == 7


def test_reviews_writer_roundtrip(spark):
    df = spark.createDataFrame([("r1", "b1", "c", "A, \"q\"", "", dt.date(2024, 1, 2), None, "", "", "", "x\ny",
                                 4, True, False)],
                               "review_id string, branch_id string, client_id string, client_first_name string, "
                               "client_last_name string, review_date date, visit_date date, staff_id string, "
                               "staff_first_name string, staff_last_name string, text string, rating long, "
                               "facebook_review boolean, twitter_review boolean")
    out = scratch_path(spark, "t-k1")
    K.write_csv(df, out, REVIEWS)
    back = C.read_csv_dir(spark, out, REVIEWS).rows.drop("_file", "_row")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    K.archive(df, scratch_path(spark, "t-k2"), REVIEWS, "20240201_000000")


def test_json_pages_roundtrip_and_stop(spark):
    root = scratch_path(spark, "t-json").replace("file:", "")
    doc = lambda items, n, total: json.dumps({"_embedded": {"products": items},
                                              "page": {"size": 2, "totalElements": 3, "totalPages": total, "number": n}})
    _write(os.path.join(root, "branch_id=b1"), "p.json",
           (doc([{"productId": "p1", "brandName": "", "price": 0, "quantityInStock": 0,
                  "updatedAt": "2024-01-02T03:04:05Z"}, {"productId": "p2"}], 0, 3) + "\n"
            + doc([], 1, 3) + "\n" + doc([{"productId": "p3"}], 2, 3) + "\n").encode())
    rows, pages = PG.read_pages(spark, root, "products")
    got = {r.product_id: r for r in PG.parse_item_times(rows, "products").collect()}
    assert got["p1"].brand_name == "" and got["p1"].quantity_in_stock == 0.0
    assert got["p1"].updated_at is not None and got["p2"].updated_at is None and got["p2"].pos == 1
    from tidemark.operators.pages import valid_pages
    assert sorted(r.page for r in valid_pages(pages).collect()) == [0]  # page 1 is empty -> stop
    # writer -> reader round trip
    out = scratch_path(spark, "t-json2")
    src = spark.createDataFrame([("b1", 0, 0, "r1", "2024-01-02", 5), ("b1", 0, 1, "r2", "", 1), ("b2", 0, 0, "r3", "x", 2)],
                                "branch_id string, page long, pos long, review_id string, review_date string, rating long")
    PG.write_pages(src, out, "reviews", 100)
    back, _ = PG.read_pages(spark, out, "reviews")
    back = {r.review_id: r for r in PG.parse_item_times(back, "reviews").collect()}
    assert back["r1"].review_date == dt.date(2024, 1, 2) and back["r2"].review_date is None and back["r3"].pos == 0


def test_publish_manifest(spark):
    root = scratch_path(spark, "t-hub")
    a = spark.createDataFrame([(1,)], "k int")
    SN.publish(spark, root, "20240101000000", {"t1": a, "t2": a})
    SN.publish(spark, root, "20240102000000", {"t1": a.union(a)})
    assert SN.read_table(spark, root, "t1").count() == 2 and SN.read_table(spark, root, "t2").count() == 1
    assert SN.lookup(SN.read_table(spark, root, "t1"), {"k": 1}).count() == 2


def test_bucketed_merge_touches_only_its_buckets(spark):
    root = scratch_path(spark, "t-bucket")
    t = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("old").alias("p"))
    SN.publish_bucketed(spark, root, "20240101000000", "t", t, ["k"], buckets=64)
    src = spark.createDataFrame([(5, 2, "new"), (5000, 1, "ins")], "k long, v int, p string")
    from tidemark.operators.merge import merge
    info = SN.merge_into(spark, root, "20240102000000", "t", src,
                         lambda a, b: merge(a, b, ["k"], "newer", "v"),
                         extra={"hwm": spark.createDataFrame([(1,)], "x int")})
    assert info["touched"] <= 2 and info["buckets"] >= 60
    out = {r.k: r.p for r in SN.read_table(spark, root, "t").collect()}
    assert len(out) == 1001 and out[5] == "new" and out[5000] == "ins" and out[6] == "old"
    assert SN.read_table(spark, root, "hwm").count() == 1


def test_staff_and_branch_envelopes(spark):
    root = scratch_path(spark, "t-staff").replace("file:", "")
    _write(os.path.join(root, "branch_id=b1"), "s.json", json.dumps({"_embedded": {"staffs": [
        {"staffId": "s1", "firstName": "Al", "birthDate": "1990-05-06T23:30:00-05:00", "archived": True},
        {"staffId": "s2", "birthDate": "1991-01-02 10:00:00"}, {"staffId": "s3", "birthDate": "bad"}]}}).encode())
    rows, pages = PG.read_pages(spark, root, "staff")
    got = {r.staff_id: r for r in PG.parse_item_times(rows, "staff").collect()}
    assert got["s1"].birth_date == dt.date(1990, 5, 6) and got["s1"].archived is True
    assert got["s2"].birth_date == dt.date(1991, 1, 2) and got["s2"].first_name == "" and got["s2"].archived is False
    assert got["s3"].birth_date is None and got["s2"].start_date is None and got["s1"].branch_id == "b1"
    broot = scratch_path(spark, "t-branch").replace("file:", "")
    _write(os.path.join(broot, "branch_id=ALL"), "b.json", json.dumps({"_embedded": {"branches": [
        {"branchId": "b1", "name": "Main", "latitude": 53.3}, {"branchId": "b2"}]}}).encode())
    br = {r.name: r for r in PG.read_pages(spark, broot, "branches")[0].collect()}
    assert br["Main"].latitude == 53.3 and br[""].latitude is None and br[""].account_id is None


def test_splittable_csv_keeps_header_and_order(spark):
    root = scratch_path(spark, "t-split").replace("file:", "")
    body = "note,id,qty\n" + "".join(f"n{i},{i},{i % 7}\n" for i in range(3000))
    _write(root, "big.csv", body.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        batch = C.read_csv_dir(spark, root, MINI, quoted_newlines=False)
        rows = batch.rows.orderBy("_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.id for r in rows] == [str(i) for i in range(3000)]
    assert rows[5].qty == 5.0 and rows[5].note == "n5"
    assert [r.ok for r in batch.files.collect()] == [True]


def test_multiline_and_malformed_envelopes(spark):
    root = scratch_path(spark, "t-pretty").replace("file:", "")
    doc = {"_embedded": {"reviews": [{"reviewId": "r1", "rating": 4}, {"reviewId": "r2"}]},
           "page": {"size": 2, "totalElements": 2, "totalPages": 3, "number": 0}}
    _write(os.path.join(root, "branch_id=b1"), "p0.json", json.dumps(doc, indent=2).encode())
    _write(os.path.join(root, "branch_id=b1"), "p1.json", b"{ not json")
    with pytest.raises(Exception, match="cannot be decoded"):
        PG.read_pages(spark, root, "reviews", multiline=True)[0].collect()
    with pytest.raises(Exception, match="cannot be decoded"):  # a document over several lines, read line by line
        PG.read_pages(spark, root, "reviews")[0].collect()
    assert [r.page_text for r in PG.bad_pages(spark, root, "reviews", multiline=True).collect()] == ["{ not json"]
    rows, pages = PG.read_pages(spark, root, "reviews", multiline=True, on_bad_page="skip")
    got = sorted((r.review_id, r.rating, r.pos) for r in rows.collect())
    assert got == [("r1", 4, 0), ("r2", 0, 1)]
    from tidemark.operators.pages import valid_pages
    assert sorted(r.page for r in valid_pages(pages).collect()) == [0]


def test_failed_publish_leaves_previous_versions_visible(spark):
    root = scratch_path(spark, "t-atomic")
    a = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    SN.publish_bucketed(spark, root, "20240101000000", "items", a, ["k"], buckets=8)
    SN.publish_bucketed(spark, root, "20240101000001", "headers", a, ["k"], buckets=8)
    batch = spark.createDataFrame([(1, 2)], "k long, v int")
    from tidemark.operators.merge import merge

    def boom(target, source):
        raise RuntimeError("simulated failure while planning the second table")

    try:
        SN.upsert_tables(spark, root, "20240102000000",
                         {"items": (["k"], batch, lambda t, s: merge(t, s, ["k"], "always"), None),
                          "headers": (["k"], batch, boom, None)})
        raise AssertionError("expected failure")
    except RuntimeError:
        pass
    # items' new bucket files were written, but no manifest names them
    assert {r.k: r.v for r in SN.read_table(spark, root, "items").collect()}[1] == 1
    assert {r.k: r.v for r in SN.read_table(spark, root, "headers").collect()}[1] == 1


def test_csv_rows_join_file_table_by_broadcast(spark):
    root = scratch_path(spark, "t-plan").replace("file:", "")
    _write(root, "a.csv", b"id,qty\n1,2\n3,4\n")
    rows = C.read_csv_dir(spark, root, MINI).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
