"""Manifests: nothing is lost when storage fails or a run is repeated."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import daily as D
from tidemark.session import checkpoint_root, scratch_path
from tidemark.sources import snapshots as SN


def test_a_storage_error_is_not_an_empty_hub(spark, monkeypatch):
    root = scratch_path(spark, "t-hub")
    SN.publish(spark, root, "01", {"a": spark.range(3)})
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **k: (_ for _ in ()).throw(OSError("storage is away")))
    with pytest.raises(OSError):
        SN.publish(spark, root, "02", {"b": spark.range(1)})
    monkeypatch.undo()
    assert set(SN.latest_manifest(spark, root)) == {"a"}


def test_a_failed_commit_and_its_retry_leave_one_run(spark, monkeypatch):
    hub = scratch_path(spark, "t-hub")
    rows = spark.createDataFrame([("b1", 0, 0, "p1", 3.0), ("b1", 0, 1, "p1", 4.0), ("b1", 1, 0, "p1", 5.0)],
                                 "branch_id string, page long, pos long, product_id string, quantity_in_stock double")
    more = {c: F.lit(None).cast(t) for c, t in (("parent_product_id", "string"), ("name", "string"), ("brand_id", "string"), ("brand_name", "string"), ("category_id", "string"), ("category_name", "string"), ("code", "string"), ("type", "string"), ("measurement_unit", "string"), ("created_at", "string"), ("updated_at", "string"), ("archived", "boolean"), ("price", "double"), ("min_quantity", "double"), ("max_quantity", "double"), ("reorder_count", "double"), ("reorder_cost", "double"), ("measurement_quantity", "double"))}
    rows = rows.withColumns(more)
    commit = SN._commit
    monkeypatch.setattr(SN, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        D.products_phase(spark, rows, hub, "01", dt.date(2025, 1, 2))
    assert SN.latest_manifest(spark, hub) == {}
    monkeypatch.setattr(SN, "_commit", commit)
    for _ in range(2):
        D.products_phase(spark, rows, hub, "01", dt.date(2025, 1, 2))
    assert SN.read_table(spark, hub, "product_stock_history").count() == 3
    assert [r.quantity_in_stock for r in D.register_stock_view(spark, hub).collect()] == [5.0]


def test_now_without_a_zone_is_utc():
    assert D.utc(dt.datetime(2025, 1, 5, 23, 59)).isoformat() == "2025-01-05T23:59:00+00:00"


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
