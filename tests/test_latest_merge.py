"""A1/A2/A11 newest-per-key rules and the J1-J8 merge guards (FIXTURES section 6)."""

import datetime as dt


from tidemark.operators import latest as L
from tidemark.operators import merge as M


def test_latest_versions_null_ties(spark):
    # versions NULL,3,3,1 -> first row with 3
    df = spark.createDataFrame([("k", None, 0), ("k", 3, 1), ("k", 3, 2), ("k", 1, 3)], "k string, v int, seq int")
    out = L.latest_by_key(df, ["k"], "v", ["seq"]).collect()
    assert [(r.v, r.seq) for r in out] == [(3, 1)]


def test_all_null_versions_file_rule(spark):
    # one file r1,r2 -> r1 ; two files f1,f2 -> f2's row
    df = spark.createDataFrame([("a", None, "f1", 1), ("a", None, "f1", 2),
                                ("b", None, "f1", 1), ("b", None, "f2", 1),
                                ("c", 5, "f1", 1), ("c", 5, "f2", 1)], "k string, v int, f string, r int")
    out = {r.k: (r.f, r.r) for r in L.latest_by_key(df, ["k"], order=L.file_order("v", "f", "r")).collect()}
    assert out == {"a": ("f1", 1), "b": ("f2", 1), "c": ("f1", 1)}


def test_last_value_per_day_keeps_null(spark):
    df = spark.createDataFrame([
        ("p", dt.datetime(2024, 1, 1, 8), 5.0), ("p", dt.datetime(2024, 1, 1, 9), None),
        ("p", dt.datetime(2024, 1, 2, 9), 7.0)], "k string, t timestamp, q double")
    out = {r.stock_date: r.q for r in L.last_value_per_day(df, ["k"], "t", ["q"]).collect()}
    assert out == {dt.date(2024, 1, 1): None, dt.date(2024, 1, 2): 7.0}


def test_duplicate_keys_and_strict(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in L.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    try:
        L.assert_unique(df, ["k"])
        raise AssertionError("expected failure")
    except ValueError:
        pass


def _guard_case(spark, old, new):
    t = spark.createDataFrame([("k", old, "old")], "id string, v int, payload string")
    s = spark.createDataFrame([("k", new, "new")], "id string, v int, payload string")
    return M.merge(t, s, ["id"], "newer", "v").collect()[0].payload


def test_newer_guard_table(spark):
    # old NULL/new NULL; old 5/new 5; old 5/new NULL; old 5/new 6 -> new; old; old; new
    assert [_guard_case(spark, o, n) for o, n in [(None, None), (5, 5), (5, None), (5, 6)]] == [
        "new", "old", "old", "new"]


def test_insert_only_and_audit(spark):
    t = spark.createDataFrame([("i1", 1, "shampoo", 10.0, dt.date(2024, 1, 1), dt.date(2024, 1, 1))],
                              "id string, v int, product_name string, total double, created_at date, updated_at date")
    s = spark.createDataFrame([("i1", 2, "conditioner", 12.0), ("i2", 1, "gel", 3.0)],
                              "id string, v int, product_name string, total double")
    out = {r.id: r for r in M.merge(t, s, ["id"], "newer", "v", insert_only=["product_name"],
                                    created_col="created_at", updated_col="updated_at",
                                    run_ts=dt.date(2024, 2, 1)).collect()}
    assert out["i1"].product_name == "shampoo" and out["i1"].total == 12.0
    assert out["i1"].created_at == dt.date(2024, 1, 1) and out["i1"].updated_at == dt.date(2024, 2, 1)
    assert out["i2"].product_name == "gel" and out["i2"].created_at == dt.date(2024, 2, 1)


def test_absent_first_occurrence(spark):
    # reviews: id seen twice with changed text -> first text kept
    t = spark.createDataFrame([("r1", "first")], "review_id string, text string")
    s = spark.createDataFrame([("r1", "changed", 1), ("r2", "a", 2), ("r2", "b", 1)], "review_id string, text string, seq int")
    out = {r.review_id: r.text for r in M.merge(t, s, ["review_id"], "absent", dedup=True, seq=["seq"]).collect()}
    assert out == {"r1": "first", "r2": "b"}


def test_always_overwrite_and_replay(spark):
    t = spark.createDataFrame([("b1", "old", 1)], "branch_id string, name string, v int")
    s = spark.createDataFrame([("b1", "new", 0), ("b2", "x", 0)], "branch_id string, name string, v int")
    once = M.merge(t, s, ["branch_id"], "always")
    assert {r.branch_id: r.name for r in once.collect()} == {"b1": "new", "b2": "x"}
    n1 = M.merge(t, s, ["branch_id"], "newer", "v")
    n2 = M.merge(n1, s, ["branch_id"], "newer", "v")
    assert sorted(map(tuple, n1.collect())) == sorted(map(tuple, n2.collect()))


def test_merge_with_action(spark):
    t = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    s = spark.createDataFrame([("a", 2), ("c", 1)], "k string, v int")
    acts = {r.k: r._action for r in M.merge(t, s, ["k"], "newer", "v", with_action=True).collect()}
    assert acts == {"a": "update", "b": "keep", "c": "insert"}


def test_refresh_keeps_last_occurrence(spark):
    from tidemark.operators.watermarks import empty_hwm
    from tidemark.plans.jobs import refresh_job
    landed = spark.createDataFrame([("s1", "b1", "A", 0, 0), ("s1", "b1", "B", 0, 1), ("s2", "", "C", 0, 2)],
                                   "staff_id string, branch_id string, first_name string, page long, pos long")
    target = spark.createDataFrame([], "staff_id string, branch_id string, first_name string")
    out = refresh_job(landed, target, ["staff_id", "branch_id"], empty_hwm(spark, "timestamp", "date"), "staff_api",
                      dt.date(2024, 2, 1))
    assert [tuple(r) for r in out["table"].collect()] == [("s1", "b1", "B")]
    assert [(r.entity, r.branch_id) for r in out["hwm"].collect()] == [("staff_api", "b1")]
