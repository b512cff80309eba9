"""The daily run end to end over hand-made landings, twice (idempotent)."""

import datetime as dt
import json
import os

from tidemark.plans.daily import Landing, run_daily
from tidemark.session import scratch_path
from tidemark.sources import snapshots as SN
from tidemark.sources.specs import TRANSACTIONS


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _tx(rows):
    cols = [c for c, _, _ in TRANSACTIONS.columns]
    return ",".join(cols) + "\n" + "".join(",".join(r.get(c, "") for c in cols) + "\n" for r in rows)


def _env(arr, items, n=0, total=1):
    return json.dumps({"_embedded": {arr: items}, "page": {"size": 100, "totalElements": len(items),
                                                           "totalPages": total, "number": n}}) + "\n"


def test_daily_run_twice(spark):
    base = scratch_path(spark, "t-daily").replace("file:", "")
    hub = scratch_path(spark, "t-daily-hub")
    _w(f"{base}/tx_seed/a.csv", _tx([
        {"transaction_id": "t1", "transaction_item_id": "i1", "branch_id": "b1", "total_amount": "10",
         "purchase_updated_at": "2025-01-01 10:00:00"},
        {"transaction_id": "t2", "transaction_item_id": "i2", "branch_id": "b2", "total_amount": "5",
         "purchase_updated_at": "2025-01-03 09:00:00"}]))
    _w(f"{base}/cl_seed/a.csv", "client_id,updated_at,first_name\nc1,2025-01-01,Ann\nc2,2025-01-02,Bo\n")
    _w(f"{base}/rv_seed/a.csv", "review_id,branch_id,review_date,text\nr0,b1,2024-12-31,old\n")
    _w(f"{base}/tx/a.csv", _tx([
        {"transaction_id": "t1", "transaction_item_id": "i1", "branch_id": "b1", "total_amount": "11",
         "purchase_updated_at": "2025-01-02 10:00:00"},
        {"transaction_id": "t3", "transaction_item_id": "i3", "branch_id": "b2", "total_amount": "7",
         "purchase_updated_at": "2025-01-02 08:00:00"}]))  # before b2's mark day -> outside the window
    _w(f"{base}/cl/a.csv", "client_id,updated_at,first_name\nc1,2025-01-03,Anna\nc2,2025-01-01,Old\nc3,2025-01-04,Cy\n")
    _w(f"{base}/staff/branch_id=b1/p.json", json.dumps({"_embedded": {"staffs": [{"staffId": "s1", "firstName": "Al"}]}}))
    _w(f"{base}/branches/branch_id=ALL/p.json",
       json.dumps({"_embedded": {"branches": [{"branchId": "b1", "name": "Main"}, {"branchId": "b2"}]}}))
    _w(f"{base}/rv_pages/branch_id=b1/p.json",
       _env("reviews", [{"reviewId": "r1", "reviewDate": "2025-01-04"}, {"reviewId": "r0"}], 0, 1))
    _w(f"{base}/pr_pages/branch_id=b1/p.json",
       _env("products", [{"productId": "p1", "quantityInStock": 3, "price": 2.5, "updatedAt": "2025-01-04T10:00:00Z"},
                         {"productId": "p1", "quantityInStock": 3, "price": 3.0, "updatedAt": "2025-01-04T11:00:00Z"},
                         {"productId": "p2", "quantityInStock": 0, "updatedAt": "2025-01-04T09:00:00Z"}]))
    landing = Landing(f"{base}/tx_seed", f"{base}/cl_seed", f"{base}/rv_seed", f"{base}/tx", f"{base}/cl",
                      f"{base}/rv_pages", f"{base}/pr_pages", f"{base}/staff", f"{base}/branches")
    done = run_daily(spark, landing, hub, "20250105000000", dt.date(2025, 1, 5))
    assert done == ["bootstrap", "reviews_bootstrap", "staff", "branches", "clients", "transactions", "reviews",
                    "products"]

    def snap():
        t = {}
        for name, cols in [("transaction_items", ["transaction_item_id", "total_amount"]),
                           ("clients", ["client_id", "first_name"]), ("reviews", ["review_id", "branch_id"]),
                           ("staff", ["staff_id", "first_name"]), ("branches", ["branch_id", "name"]),
                           ("product_stock", ["product_id", "quantity_in_stock", "price"]),
                           ("hwm", ["entity", "branch_id", "last_updated"])]:
            t[name] = sorted(tuple(r) for r in SN.read_table(spark, hub, name).select(*cols).collect())
        return t

    first = snap()
    assert first["transaction_items"] == [("i1", 11.0), ("i2", 5.0)]
    assert first["clients"] == [("c1", "Anna"), ("c2", "Bo"), ("c3", "Cy")]
    assert first["reviews"] == [("r0", "b1"), ("r1", "b1")]
    assert first["product_stock"] == [("p1", 3.0, 3.0), ("p2", 0.0, None)]
    marks = {(e, b): t for e, b, t in first["hwm"]}
    assert marks[("transactions_csv", "b2")] == dt.datetime(2025, 1, 3, 9)
    assert marks[("clients_csv", "ALL")] == dt.datetime(2025, 1, 4)
    assert ("staff_api", "b1") in marks and ("branches_api", "ALL") in marks and ("products_api", "b1") in marks
    hist = SN.read_table(spark, hub, "product_stock_history").count()
    assert hist == 2  # p1 first sight (price change alone emits nothing), p2 first sight

    done2 = run_daily(spark, landing, hub, "20250106000000", dt.date(2025, 1, 6))
    assert "bootstrap" not in done2 and "reviews_bootstrap" not in done2
    second = snap()
    for name in ("transaction_items", "clients", "reviews", "staff", "branches", "product_stock"):
        assert second[name] == first[name], name
