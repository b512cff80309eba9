"""Large files in a micro-batch."""

from tidemark.sources import csv as C
from tidemark.streaming import stream as ST


def test_large_file_of_a_stream_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """a micro-batch takes the batch reader's path for large files."""
    from tidemark.plans.q_io import EVENTS_FEED
    text = "event_id,ts,user_id,event_type,value,props\n" + "".join(f"{k},2024-01-01 00:00:00,{k},a,1,p\n" for k in range(50))
    (tmp_path / "a.csv").write_text(text)
    calls, whole = [], C.parallel_records
    monkeypatch.setattr(C, "parallel_records", lambda spark, files, width: calls.append(files) or whole(spark, files, width))
    monkeypatch.setattr(C.stage, "__defaults__", (*C.stage.__defaults__[:-1], 100))
    monkeypatch.setattr(C.read_csv_dir, "__defaults__", (*C.read_csv_dir.__defaults__[:-1], 100))
    batch = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    assert ST._loaded(spark, batch, EVENTS_FEED).count() == 50 and len(calls) == 1


def test_a_long_file_is_staged_in_several(spark, monkeypatch):
    """what one task reads, several tasks go on with."""
    monkeypatch.setattr(C, "STAGED_ROWS", 100)
    staged = C.stage_records(spark, spark.range(0, 1000, 1, 1))
    assert len(staged.inputFiles()) == 10 and staged.count() == 1000


def test_tasks_for_lines_grow_with_the_files(spark, tmp_path, monkeypatch):
    """lines and pieces of records are dealt by the size of the files, and read the same."""
    from tidemark.plans.q_io import EVENTS_FEED
    text = "event_id,ts,user_id,event_type,value,props\n" + "".join(f'{k},2024-01-01 00:00:00,{k},a,1,"p\n{k}"\n' for k in range(500))
    (tmp_path / "a.csv").write_text(text)
    files = C.large_files(spark, str(tmp_path), "*.csv", 0)
    few = C._parts(spark, files)
    monkeypatch.setattr(C, "PART_BYTES", 500)
    assert C._parts(spark, files) == -(-len(text) // 500) > few
    rows = C.read_csv_dir(spark, str(tmp_path), EVENTS_FEED, large=0).rows.select("event_id", "props").collect()
    assert sorted(tuple(r) for r in rows) == [(k, f"p\n{k}") for k in range(500)]
