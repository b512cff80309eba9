"""Round trips through archives, and what a damaged one raises."""

import gzip
import hashlib
import io

import pytest

from tidemark.llm.warc import inflated, read_archives, read_record, record, write_archives

BIG = "<p>é😀</p>" * 400
PAGES = [(1, "http://a/x", BIG), (2, None, BIG), (3, "http://b\r\n/y z", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
         (None, "u", BIG), (7, "u", "\r\n\r\n" * 600), (2, "u", BIG), (8, "u", "long " * 300_000), (9, "u", "long " * 300_000)]
SCHEMA = "page_id long, url string, html string, digest string, refers_to long"


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash", 5) for p in PAGES], SCHEMA)
    files = write_archives(pages, file_bytes=2000)
    assert files.agg({"records": "sum"}).first()[0] == len(PAGES)
    got = [tuple(r) for r in read_archives(files).collect()]
    want = []
    for i, url, html in PAGES:
        data = (html or "").encode()
        ids = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        top = max(ids) if len(data) >= 1000 and i != max(ids) else None
        want.append((i, None if url is None else "".join(url.split()), len(data), hashlib.sha1(data).hexdigest(), "revisit" if top else "response", top, None if top else data))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_every_record_is_a_gzip_member():
    raw = record(1, "u", b"abc", None, "d") + record(2, "u", b"x" * 5000, 1, "d")
    assert gzip.decompress(raw).count(b"WARC/1.1\r\n") == 2
    rows = [read_record(p, True) for p in inflated(io.BytesIO(raw), 7)]
    assert [(r[0], r[2], r[4], r[5]) for r in rows] == [(1, 3, "response", None), (2, 5000, "revisit", 1)]


@pytest.mark.parametrize("spoil", [lambda b: b[:-20], lambda b: gzip.compress(gzip.decompress(b).replace(b"abc", b"abd")),
                                   lambda b: gzip.compress(gzip.decompress(b)[:-1]), lambda b: gzip.compress(b"x\r\n\r\n")])
def test_damage_raises(spoil):
    with pytest.raises(ValueError):
        [read_record(p, True) for p in inflated(io.BytesIO(spoil(record(1, "u", b"abc" * 9, None, "d"))))]


def test_no_pages(spark):
    assert read_archives(write_archives(spark.createDataFrame([], SCHEMA))).count() == 0
