"""Stored tables: delta parts against merging at once, commits, references, retention, days."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators.merge import MergeRule
from tidemark.plans import daily as D
from tidemark.session import scratch_path
from tidemark.sources import days as DY
from tidemark.sources import files as FS
from tidemark.sources import snapshots as SN

DDL = "k long, j string, v long, a string, b string, first string, made date, changed date"
RULES = {g: MergeRule(("k", "j"), g, "v" if g == "newer" else None, ("first",), "made", "changed") for g in M.GUARDS}


def _rows(df):
    return sorted(map(tuple, df.select(*[c.split()[0] for c in DDL.split(", ")]).collect()), key=repr)


@pytest.mark.parametrize("guard", M.GUARDS)
@pytest.mark.parametrize("few", [True, False])
def test_delta_parts_read_as_if_merged_at_once(spark, monkeypatch, guard, few):
    """Random batches, some without a column, NULL and equal versions, NULL values."""
    if not few:  # no broadcast of the keys of the parts
        monkeypatch.setattr(SN, "DEFAULT_MAX_ROWS", 0)
    rnd, rule, root = random.Random(guard), RULES[guard], scratch_path(spark, "t-hub")
    like = spark.createDataFrame([], DDL)
    want = like
    for run in range(5):
        keys = rnd.sample([(k, j) for k in range(12) for j in "xy"], 12)
        data = [(*k, rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, f"a{run}"]), f"b{run}", rnd.choice([None, f"f{run}"])) for k in keys]
        batch = spark.createDataFrame(data, "k long, j string, v long, a string, b string, first string")
        batch = batch.drop(*[(), ("b",), ("a", "first"), (), ("b", "a")][run])
        day = dt.date(2024, 1, 1 + run)
        want = rule.apply(want, batch, day)
        SN.upsert_tables(spark, root, f"run{run}", {}, deltas={"t": SN.Delta(rule, batch, like, day)}, buckets=4)
        assert _rows(SN.read_table(spark, root, "t")) == _rows(want)
        want = want.checkpoint()
    entry = SN.latest_manifest(spark, root)["t"]
    assert len(entry["deltas"]) == 4
    some = spark.createDataFrame([(3, "x"), (99, "y")], "k long, j string")
    near = _rows(SN.read_touched(spark, root, "t", some))
    assert set(near) <= set(_rows(want)) and {r for r in _rows(want) if r[:2] == (3, "x")} <= set(near)
    SN.compact(spark, root, "compaction", "t")
    assert _rows(SN.read_table(spark, root, "t")) == _rows(want)
    assert not SN.latest_manifest(spark, root)["t"]["deltas"]


def test_a_batch_over_all_buckets_writes_only_its_own_rows(spark):
    root, rule = scratch_path(spark, "t-hub"), MergeRule(("k",), "newer", "v")
    base = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("x" * 50).alias("payload"))
    SN.upsert_tables(spark, root, "run0", {}, deltas={"t": SN.Delta(rule, base, base)}, buckets=16)
    before = SN.latest_manifest(spark, root)["t"]
    batch = spark.range(0, 20_000, 100).select(F.col("id").alias("k"), F.lit(2).alias("v"), F.lit("y").alias("payload"))
    touched = SN.upsert_tables(spark, root, "run1", {}, deltas={"t": SN.Delta(rule, batch, base)})
    after = SN.latest_manifest(spark, root)["t"]
    assert touched["t"] == 16 and after["buckets"] == before["buckets"]
    assert [d["rows"] for d in after["deltas"]] == [200] and spark.read.parquet(after["deltas"][0]["path"]).count() == 200
    assert {r.payload: r.n for r in SN.read_table(spark, root, "t").groupBy("payload").agg(F.count("*").alias("n")).collect()} == {"x" * 50: 19_800, "y": 200}
    # rows whose key no part has are not shuffled
    plan = SN.read_table(spark, root, "t")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    # the same batch again, as another run, is one more part and changes nothing
    SN.upsert_tables(spark, root, "run2", {}, deltas={"t": SN.Delta(rule, batch, base)}, max_deltas=1)
    third = SN.latest_manifest(spark, root)["t"]
    assert third["deltas"] == [] and SN.read_table(spark, root, "t").count() == 20_000


def test_dropped_rows_can_come_back_and_guards_hold_them_no_more(spark):
    root, rule = scratch_path(spark, "t-hub"), MergeRule(("k",), "newer", "v", ("first",))
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v long, first string")
    put = lambda run, df: SN.upsert_tables(spark, root, run, {}, deltas={"t": SN.Delta(rule, df, df)}, buckets=4)
    put("run0", rows((1, 9, "a"), (2, 9, "a"), (3, 9, "a")))
    assert SN.cascade_delete(spark, root, "run1", "t", rows((1, None, None), (2, None, None), (77, None, None))) == {"t": 2}
    assert [r.k for r in SN.read_table(spark, root, "t").collect()] == [3]
    put("run2", rows((1, 1, "b"), (3, 1, "b")))
    got = {r.k: (r.v, r.first) for r in SN.read_table(spark, root, "t").collect()}
    assert got == {1: (1, "b"), 3: (9, "a")}
    assert SN.cascade_delete(spark, root, "run1", "t", rows((3, None, None))) == {}  # a run that is committed
    SN.compact(spark, root, "run3", "t")
    assert {r.k: (r.v, r.first) for r in SN.read_table(spark, root, "t").collect()} == got


def test_a_key_that_is_in_use_is_not_taken(spark):
    root = scratch_path(spark, "t-hub")
    SN.publish_bucketed(spark, root, "run0", "p", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, n string"), ["k"], 4)
    SN.publish_bucketed(spark, root, "run1", "c", spark.createDataFrame([("i", 1), ("j", 2), ("l", 2)], "id string, of long"), ["id"], 4)
    moves = lambda *m: spark.createDataFrame(list(m), "old_key long, new_key long")
    with pytest.raises(ValueError, match="in use"):
        SN.cascade_rekey(spark, root, "run2", "p", "k", moves((1, 3)), [("c", "of")])
    with pytest.raises(ValueError, match="more than once"):
        SN.cascade_rekey(spark, root, "run2", "p", "k", moves((1, 8), (2, 8)))
    # a swap moves both at once
    SN.cascade_rekey(spark, root, "run2", "p", "k", moves((1, 2), (2, 1), (3, 3), (50, 60)), [("c", "of")])
    assert sorted(map(tuple, SN.read_table(spark, root, "p").collect())) == [(1, "b"), (2, "a"), (3, "c")]
    assert sorted(map(tuple, SN.read_table(spark, root, "c").collect())) == [("i", 2), ("j", 1), ("l", 1)]


def test_grandchildren_go_too(spark):
    root = scratch_path(spark, "t-hub")
    SN.publish_bucketed(spark, root, "r0", "a", spark.createDataFrame([(1,), (2,)], "a long"), ["a"], 2)
    SN.publish_bucketed(spark, root, "r1", "b", spark.createDataFrame([(10, 1), (20, 2), (30, 1)], "b long, a long"), ["b"], 2)
    SN.publish_bucketed(spark, root, "r2", "c", spark.createDataFrame([(100, 10), (200, 20), (300, 30)], "c long, b long"), ["c"], 2)
    lost = SN.cascade_delete(spark, root, "r3", "a", spark.createDataFrame([(1,)], "a long"), [("b", "a", {"a": "a"}), ("c", "b", {"b": "b"})])
    assert lost == {"a": 1, "b": 2, "c": 2}
    assert [r.c for r in SN.read_table(spark, root, "c").collect()] == [200]


def test_a_manifest_number_is_created_once(spark):
    path = f"{scratch_path(spark, 't-files')}/1.json"
    assert FS.create_exclusive(spark, path, "one") and not FS.create_exclusive(spark, path, "two")
    assert [r[0] for r in spark.read.text(path).collect()] == ["one"]


def test_a_writer_that_loses_the_number_goes_on_top(spark, monkeypatch):
    """Another run commits between this run's look at the manifests and its own creation of one."""
    root = scratch_path(spark, "t-hub")
    at = SN.snapshot(spark, root)
    create, others = FS.create_exclusive, [True]

    def late(s, path, text):
        if others.pop() if others else False:
            SN.publish(spark, root, "other", {"b": spark.range(2)})
        return create(s, path, text)

    monkeypatch.setattr(FS, "create_exclusive", late)
    SN.publish(spark, root, "mine", {"a": spark.range(3)}, at)
    assert set(SN.latest_manifest(spark, root)) == {"a", "b"}
    now = SN.snapshot(spark, root)
    assert now.number == 2 and set(now.recent) == {"mine", "other"}


def test_conflicts_are_raised_and_tried_again(spark):
    root, starts = scratch_path(spark, "t-hub"), []
    SN.publish(spark, root, "run0", {"n": spark.range(1)})

    def work():
        at = SN.snapshot(spark, root)
        starts.append(at.number)
        more = SN.read_table(spark, root, "n", at).unionByName(spark.range(1))
        if len(starts) == 1:
            SN.publish(spark, root, "other", {"n": spark.range(5)})
        return SN.publish(spark, root, "mine", {"n": more}, at)

    SN.committing(work)
    assert starts == [1, 2] and SN.read_table(spark, root, "n").count() == 6
    at = SN.snapshot(spark, root)
    SN.publish(spark, root, "later", {"n": spark.range(7)})
    with pytest.raises(SN.Conflict, match="later"):  # what was only read counts as well
        SN.publish(spark, root, "third", {"of_n": spark.range(1)}, at, reads=["n"])
    assert "of_n" not in SN.latest_manifest(spark, root)
    assert SN.committed(spark, root, "third") is None and SN.committed(spark, root, "mine") is not None


def test_expired_versions_are_gone_and_kept_ones_are_read(spark):
    root = scratch_path(spark, "t-hub")
    for k in range(5):
        SN.publish(spark, root, f"run{k}", {"t": spark.range(k + 1), **({"once": spark.range(9)} if k == 0 else {})})
    kept = SN.snapshot(spark, root)
    spark.range(3).write.parquet(f"{root}/t/v=lost-1")  # an attempt that never committed
    assert SN.expire(spark, root, keep=2) == {"manifests": 3, "folders": 0}  # all within the grace
    assert SN.expire(spark, root, keep=2, grace_hours=0) == {"manifests": 0, "folders": 4}
    assert SN.read_table(spark, root, "t", kept).count() == 5 and SN.read_table(spark, root, "once").count() == 9
    assert SN.committed(spark, root, "run0") is not None  # still known, so a retry changes nothing
    SN.publish(spark, root, "run0", {"t": spark.range(1)})
    assert SN.read_table(spark, root, "t").count() == 5
    with pytest.raises(ValueError):
        SN.expire(spark, root, keep=0)


def _opened(df):
    return {FS.plain(f) for f in df.inputFiles()}


def test_point_reads_open_one_bucket(spark):
    root = scratch_path(spark, "t-hub")
    SN.publish_bucketed(spark, root, "run0", "t", spark.range(500).withColumn("x", F.col("id") * 2), ["id"], 32)
    found = SN.find(spark, root, "t", {"id": 77})
    assert [r.x for r in found.collect()] == [154]
    assert len({os.path.dirname(f) for f in _opened(found)}) == 1


def test_only_the_days_of_a_run_are_read_and_written(spark):
    hub = scratch_path(spark, "t-hub")
    rows = lambda *r: spark.createDataFrame(list(r), "branch_id string, product_id string, snapshot_time timestamp, quantity_in_stock double, price double, feed_seq long")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    D.append_history(spark, hub, "run0", rows(("b", "p", at(1, 9), 1.0, 1.0, 1), ("b", "p", at(2, 9), 2.0, 1.0, 2), ("b", "q", at(2, 9), None, None, 3)))
    first = SN.latest_manifest(spark, hub)
    # late for day 1, equal in time but earlier in the feed for day 2, and a row without a time
    D.append_history(spark, hub, "run1", rows(("b", "p", at(2, 9), 8.0, 1.0, 1), ("b", "p", at(3, 1), 3.0, 1.0, 4), ("b", "z", None, 0.0, 0.0, 5)))
    D.append_history(spark, hub, "run1", rows(("b", "p", at(2, 9), 99.0, 1.0, 9)))  # committed already
    second = SN.latest_manifest(spark, hub)
    assert second[D.DAILY]["days"]["2024-01-01"] == first[D.DAILY]["days"]["2024-01-01"]
    view = sorted((r.product_id, str(r.stock_date), r.quantity_in_stock) for r in D.register_stock_view(spark, hub).collect())
    assert view == [("p", "2024-01-01", 1.0), ("p", "2024-01-02", 2.0), ("p", "2024-01-03", 3.0), ("q", "2024-01-02", None), ("z", "None", 0.0)]
    one = D.register_stock_view(spark, hub, since=dt.date(2024, 1, 2), until=dt.date(2024, 1, 2))
    assert sorted(r.product_id for r in one.collect()) == ["p", "q"]
    assert {f.split("_day=")[1].split("/")[0] for f in _opened(one)} == {"2024-01-02", "none"}
    history = DY.read_days(spark, hub, D.HISTORY, dt.date(2024, 1, 3))
    assert history.count() == 2 and SN.read_table(spark, hub, D.HISTORY).count() == 6


def test_history_without_a_state_gets_one(spark):
    hub = scratch_path(spark, "t-hub")
    rows = spark.createDataFrame([("b", "p", dt.datetime(2024, 1, 1, 9), 1.0, 1.0, 1)], "branch_id string, product_id string, snapshot_time timestamp, quantity_in_stock double, price double, feed_seq long")
    SN.upsert_tables(spark, hub, "run0", {}, appends={D.HISTORY: rows})
    D.append_history(spark, hub, "run1", rows.withColumn("snapshot_time", F.lit(dt.datetime(2024, 1, 5))))
    assert D.register_stock_view(spark, hub).count() == 2 and SN.read_table(spark, hub, D.HISTORY).count() == 2


def test_references_read_only_the_buckets_they_name(spark):
    root = scratch_path(spark, "t-hub")
    SN.publish_bucketed(spark, root, "run0", "p", spark.range(100).withColumnRenamed("id", "k"), ["k"], 32)
    ref, at = SN.Reference("c", "p", (("of", "k"),)), SN.snapshot(spark, root)
    batch = spark.createDataFrame([(1, 5), (2, 500), (3, None), (4, 600)], "id long, of long")
    assert sorted(r.id for r in SN.missing_parents(spark, root, batch, ref, at).collect()) == [2, 4]
    also = spark.createDataFrame([(600,)], "k long")
    assert [r.id for r in SN.missing_parents(spark, root, batch, ref, at, also).collect()] == [2]
    assert [r.id for r in SN.missing_parents(spark, root, batch.where("id = 1"), ref, SN.Snapshot()).collect()] == [1]
    with pytest.raises(ValueError, match="on_orphan"):
        SN.upsert_tables(spark, root, "run1", {}, refs=[ref], on_orphan="drop")


def test_a_rule_stays_the_rule_of_its_table(spark):
    root = scratch_path(spark, "t-hub")
    df = spark.range(3).withColumn("v", F.lit(1))
    SN.upsert_tables(spark, root, "run0", {}, deltas={"t": SN.Delta(MergeRule(("id",), "newer", "v"), df, df)}, buckets=2)
    with pytest.raises(ValueError, match="is changed by"):
        SN.upsert_tables(spark, root, "run1", {}, deltas={"t": SN.Delta(MergeRule(("id",), "always"), df, df)})
    with pytest.raises(ValueError):
        MergeRule(("id",), "newer")
    with pytest.raises(ValueError):
        MergeRule(("id",), "sometimes")


def test_a_window_over_staged_days_opens_the_days_it_can_hold(spark):
    from tidemark.operators import watermarks as H

    rows = spark.createDataFrame([(i, ["b 1", "b/2", "new", None][i % 4], dt.datetime(2024, 1, 1 + i // 4, 12) if i % 17 else None) for i in range(80)],
                                 "id long, branch_id string, ts timestamp")
    path = scratch_path(spark, "t-staged")
    H.stage_by_day(rows, path, "ts", "branch_id")
    hwm = H.merge_hwm(H.empty_hwm(spark), spark.createDataFrame([("e", "b 1", dt.datetime(2024, 1, 10, 12)), ("e", "b/2", dt.datetime(2024, 1, 15, 12)), ("other", "new", dt.datetime(2025, 1, 1))],
                                                                "entity string, branch_id string, last_updated timestamp"), dt.datetime(2024, 1, 1))
    for mode, now in (("after", None), ("day_window", dt.datetime(2024, 1, 17)), ("between", dt.datetime(2024, 1, 17)), ("between", None)):
        for keep in (False, True):
            want = H.incremental_window(rows, hwm, "ts", mode, now, "branch_id", "e", keep_null=keep)
            got = H.staged_window(spark, path, hwm, "ts", mode, now, "branch_id", "e", keep_null=keep)
            assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()), (mode, now, keep)
    got = H.staged_window(spark, path, hwm, "ts", "day_window", dt.datetime(2024, 1, 17), "branch_id", "e")
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()


def test_a_read_of_one_table_reads_the_index_of_no_other(spark, monkeypatch):
    root = scratch_path(spark, "t-hub")
    SN.publish_bucketed(spark, root, "run0", "t", spark.range(50), ["id"], 8)
    SN.publish_bucketed(spark, root, "run1", "u", spark.range(50), ["id"], 8)
    read, told = SN._manifest, []
    monkeypatch.setattr(SN, "_manifest", lambda s, f: told.append(f) or read(s, f))
    assert SN.find(spark, root, "t", {"id": 7}).count() == 1
    assert len(told) == 2 and not any("/u/" in f for f in told)
