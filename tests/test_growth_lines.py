"""Large exports whose lines are records, and few files for many tasks."""

import pytest

from tidemark.sources import csv as C
from tidemark.sources.specs import FeedSpec, _parse

SPEC = FeedSpec("notes", _parse("id text\nnote text\n"), key=("id",), clean="none")


def _rows(spark, path, large):
    batch = C.read_csv_dir(spark, str(path), SPEC, large=large)
    return sorted((r._file.split("/")[-1], r.id, r.note) for r in batch.rows.collect()), sorted((r._file.split("/")[-1], r.n_records, r.ok) for r in batch.files.collect())


@pytest.fixture
def exports(tmp_path):
    (tmp_path / "plain.csv").write_text("id,note\n" + "".join(f'{k},"a ""b"", {k}"\n' for k in range(300)) + "\n300,end", newline="")
    (tmp_path / "crlf.csv").write_text("note,id\r\n" + "".join(f'"x, {k}",{k}\r\n' for k in range(200)), newline="")
    return tmp_path


def test_lines_with_paired_quotes_are_records(spark, exports, monkeypatch):
    want = _rows(spark, exports, 1 << 30)
    monkeypatch.setattr(C, "_joined_lines", lambda *a: pytest.fail("no line goes on"))
    assert _rows(spark, exports, 10) == want and len(want[0]) == 501


def test_lines_of_both_kinds(spark, exports):
    (exports / "broken.csv").write_text("id,note\n" + "".join(f'{k},"a\n{k}"\n' for k in range(100)), newline="")
    (exports / "stray.csv").write_text('id,note\n1,a"b\n2,c\n', newline="")
    assert _rows(spark, exports, 10) == _rows(spark, exports, 1 << 30)


def test_few_files_are_read_by_many_tasks(spark, exports, monkeypatch):
    size = C.large_size(spark, str(exports), "*.csv", 1 << 30)
    assert size == C.LARGE_OF_FEW and C.large_size(spark, str(exports), "*.csv", 10) == 10
    monkeypatch.setattr(C, "LARGE_OF_FEW", 1)
    total = sum(f.stat().st_size for f in exports.iterdir())
    assert C.large_size(spark, str(exports), "*.csv", 1 << 30) == max(1, 2 * (total // spark.sparkContext.defaultParallelism))
