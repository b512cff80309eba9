"""Sizing helpers."""

from tidemark.session import recommended_conf


def test_recommended_conf_bounds():
    big = recommended_conf(100 << 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    small = recommended_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.session.timeZone"] == "UTC"


def test_scratch_of_a_run_is_gone_after_it(spark):
    import pytest

    from tidemark.session import scratch_path, scratch_run
    from tidemark.sources.files import folders

    with pytest.raises(RuntimeError), scratch_run(spark, "20240101") as folder:
        path = scratch_path(spark, "rows")
        spark.range(3).write.parquet(path)
        assert path.startswith(folder) and spark.read.parquet(path).count() == 3 and len(folders(spark, folder)) == 1
        raise RuntimeError("the run fails")
    assert folders(spark, folder) == [] and folder not in scratch_path(spark, "rows")
