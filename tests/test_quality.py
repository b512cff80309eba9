"""J12-J16 integrity helpers on tiny frames."""

import pytest

from tidemark.operators import quality as Q


def test_orphans_strict_and_cascade(spark):
    parent = spark.createDataFrame([("t1",), ("t2",)], "transaction_id string")
    child = spark.createDataFrame([("i1", "t1"), ("i2", "t3"), ("i3", "t2")], "item_id string, tx string")
    on = {"tx": "transaction_id"}
    assert [r.item_id for r in Q.orphans(child, parent, on).collect()] == ["i2"]
    with pytest.raises(ValueError):
        Q.assert_no_orphans(child, parent, on, "items")
    deleted = spark.createDataFrame([("t1",)], "transaction_id string")
    assert sorted(r.item_id for r in Q.cascade_delete(child, deleted, on).collect()) == ["i2", "i3"]


def test_rekey_known_and_counts(spark):
    child = spark.createDataFrame([("i1", "t1", 2.0), ("i2", "t2", 3.0), ("i3", "t2", 4.0)],
                                  "item_id string, tx string, qty double")
    key_map = spark.createDataFrame([("t2", "T2")], "old_key string, new_key string")
    assert sorted((r.item_id, r.tx) for r in Q.rekey(child, key_map, "tx").collect()) == [
        ("i1", "t1"), ("i2", "T2"), ("i3", "T2")]
    batch = spark.createDataFrame([("b", "r1"), ("b", "r2")], "branch_id string, review_id string")
    known = spark.createDataFrame([("b", "r2"), ("c", "r1")], "branch_id string, review_id string")
    assert [r.review_id for r in Q.known(batch, known, ["branch_id", "review_id"]).collect()] == ["r2"]
    parents = spark.createDataFrame([("t1",), ("t2",), ("t9",)], "transaction_id string")
    counts = {r.transaction_id: (r.n_items, r.total_qty)
              for r in Q.child_counts(parents, child, {"transaction_id": "tx"}, "qty").collect()}
    assert counts == {"t1": (1, 2), "t2": (2, 7), "t9": (0, None)}
