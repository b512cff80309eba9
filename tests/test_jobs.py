"""End-to-end CSV imports over two runs."""

import datetime as dt
import os

from tidemark.plans import jobs as J
from tidemark.session import scratch_path
from tidemark.sources import snapshots as SN
from tidemark.sources.specs import TRANSACTIONS


def _tx_file(path, rows):
    cols = [c for c, _, _ in TRANSACTIONS.columns]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        for r in rows:
            f.write(",".join(r.get(c, "") for c in cols) + "\n")


def test_transactions_two_runs(spark):
    base = scratch_path(spark, "t-tx-runs").replace("file:", "")
    root = scratch_path(spark, "t-tx-hub")
    _tx_file(f"{base}/run1/a.csv", [
        {"transaction_id": "t1", "transaction_item_id": "i1", "branch_id": "b1", "product_name": "gel",
         "total_amount": "10", "purchase_updated_at": "2025-01-01 10:00:00"},
        {"transaction_id": "t2", "transaction_item_id": "i2", "branch_id": "b2", "total_amount": "5",
         "purchase_updated_at": "2025-01-03 10:00:00"}])
    J.transactions_import(spark, f"{base}/run1", root, "20250101000000", dt.date(2025, 1, 1))
    _tx_file(f"{base}/run2/a.csv", [
        {"transaction_id": "t1", "transaction_item_id": "i1", "branch_id": "b1", "product_name": "wax",
         "total_amount": "12", "purchase_updated_at": "2025-01-02 10:00:00"},
        {"transaction_id": "t2", "transaction_item_id": "i2", "branch_id": "b2", "total_amount": "1",
         "purchase_updated_at": "2025-01-02 10:00:00"}])  # older -> dropped
    info = J.transactions_import(spark, f"{base}/run2", root, "20250102000000", dt.date(2025, 1, 2))
    assert info["touched_buckets"]["transaction_items"] <= 2  # of 64: only the batch's buckets are rewritten
    items = {r.transaction_item_id: r for r in SN.read_table(spark, root, "transaction_items").collect()}
    assert items["i1"].total_amount == 12.0 and items["i1"].product_name == "gel"  # insert-only kept
    assert items["i1"].created_at == dt.date(2025, 1, 1) and items["i1"].updated_at == dt.date(2025, 1, 2)
    assert items["i2"].total_amount == 5.0 and items["i2"].updated_at == dt.date(2025, 1, 1)
    heads = SN.read_table(spark, root, "transactions").count()
    assert heads == 2
    hwm = {r.branch_id: r.last_updated for r in SN.read_table(spark, root, "hwm").collect()}
    assert hwm == {"b1": dt.datetime(2025, 1, 2, 10), "b2": dt.datetime(2025, 1, 3, 10)}


def test_clients_and_reviews_bootstrap(spark):
    base = scratch_path(spark, "t-cl-runs").replace("file:", "")
    root = scratch_path(spark, "t-cl-hub")
    os.makedirs(f"{base}/c", exist_ok=True)
    with open(f"{base}/c/a.csv", "w") as f:
        f.write("client_id,updated_at,first_name\nc1,2025-01-02,Ann\nc1,2025-01-01,Old\nc2,,Bo\n")
    J.clients_import(spark, f"{base}/c", root, "20250101000000", dt.date(2025, 1, 1))
    cl = {r.client_id: r.first_name for r in SN.read_table(spark, root, "clients").collect()}
    assert cl == {"c1": "Ann", "c2": "Bo"}
    hwm = SN.read_table(spark, root, "hwm").collect()
    assert [(r.entity, r.branch_id, r.last_updated) for r in hwm] == [("clients_csv", "ALL", dt.datetime(2025, 1, 2))]
    os.makedirs(f"{base}/r", exist_ok=True)
    with open(f"{base}/r/a.csv", "w") as f:
        f.write("review_id,branch_id,text\nr1,b1,first\nr1,b1,second\nr2,,dropped\n")
    assert J.reviews_bootstrap(spark, f"{base}/r", root, "20250102000000", dt.date(2025, 1, 2))
    assert not J.reviews_bootstrap(spark, f"{base}/r", root, "20250103000000", dt.date(2025, 1, 3))
    rv = [(r.review_id, r.text) for r in SN.read_table(spark, root, "reviews").collect()]
    assert rv == [("r1", "first")]


def test_repeated_item_in_one_batch_keeps_first_seen_insert_only(spark):
    base = scratch_path(spark, "t-tx-dup").replace("file:", "")
    root = scratch_path(spark, "t-tx-dup-hub")
    _tx_file(f"{base}/a.csv", [
        {"transaction_id": "t1", "transaction_item_id": "i1", "product_name": "first", "total_amount": "1",
         "purchase_updated_at": "2025-01-01 10:00:00"},
        {"transaction_id": "t1", "transaction_item_id": "i1", "product_name": "second", "total_amount": "2",
         "purchase_updated_at": "2025-01-02 10:00:00"}])
    J.transactions_import(spark, base, root, "20250101000000", dt.date(2025, 1, 1))
    r = SN.read_table(spark, root, "transaction_items").collect()
    assert len(r) == 1 and r[0].product_name == "first" and r[0].total_amount == 2.0
    try:
        J.transactions_import(spark, base, root, "20250102000000", dt.date(2025, 1, 2), strict=True)
        raise AssertionError("expected failure")
    except ValueError:
        pass
