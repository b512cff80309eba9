"""A compaction shuffles and sorts the rows once."""

from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.sources import snapshots as SN


def test_compaction_shuffles_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SN, "DEFAULT_MAX_ROWS", 0)  # parts too large to broadcast
    rule, root = M.MergeRule(("k",), "newer", "v", ("first",), "made", "changed"), str(tmp_path / "hub")
    batch = lambda a, b, v: spark.range(a, b).select((F.col("id") % 7).alias("a"), F.col("id").alias("k"), F.lit(v).alias("v"), F.lit(v).alias("first"))
    like = batch(0, 1, 0).selectExpr("*", "0 AS made", "0 AS changed")
    for run, (source, at) in enumerate([(batch(0, 500, 2), 1), (batch(300, 900, 3).drop("a"), 2), (batch(200, 400, 1), 3)]):
        SN.upsert_tables(spark, root, f"run{run}", {}, deltas={"t": SN.Delta(rule, source, like, at)}, buckets=5)
    before = sorted(map(tuple, SN.read_table(spark, root, "t").collect()), key=str)
    entry = SN.snapshot(spark, root).tables["t"]
    rows = SN._with_deltas(spark, entry, set(range(5)), to_write=True)
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and plan.count("Sort [") <= 1
    assert SN.compact(spark, root, "compaction", "t")["rewritten"] == 5
    assert not SN.snapshot(spark, root).tables["t"].get("deltas")
    assert sorted(map(tuple, SN.read_table(spark, root, "t").collect()), key=str) == before and len(before) == 900
