"""What near duplicates shuffle: packed texts, of later rounds only those that are compared, and counts of cells."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import jaccard as J
from tidemark.llm.common import BitFilter


def test_packed_texts_have_the_same_shingles():
    for text in (None, "", "A b", "één TWO three\n four five " * 50):
        assert np.array_equal(J.shingles(J.packed(text), 4), J.shingles(text, 4))
        assert J.unpacked(J.packed(text)).decode() == (text or "")


def test_cells_that_several_sets_have():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 60))) for _ in range(200)] + [""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([J.packed(t) for t in texts], pa.binary())], ["doc", "text"])
    count = J._frequencies(4, 7, lambda ids: np.ones(len(ids), bool))
    sent = [b for part in (batch.slice(0, 90), batch.slice(90)) for b in count(iter([part]))]
    assert {p for b in sent for p in b.column("part").to_pylist()} == set(range(7))
    got = {t: n for b in J._frequent(iter(sent)) for t, n in zip(b.column("token").to_pylist(), b.column("n").to_pylist())}
    cells, n = np.unique(np.concatenate([J.shingles(t, 4) >> np.uint64(32) for t in texts]), return_counts=True)
    want = dict(zip(cells.astype(np.uint64) << np.uint64(32), n))
    assert got == {int(np.uint64(c).astype(np.int64)): int(k) for c, k in want.items() if k > 1}


def test_later_rounds_deal_out_only_their_texts(spark, monkeypatch):
    seen, links = [], J._links
    monkeypatch.setattr(J, "_links", lambda pairs, texts, *a: seen.append((pairs, texts)) or links(pairs, texts, *a))
    text = lambda k: " ".join(f"w{k % 3}x{i}" for i in range(40)) + f" {k}"
    texts = spark.createDataFrame([(k, J.packed(text(k))) for k in range(300)], J.TEXTS)
    pairs = spark.createDataFrame([(1, 4), (1, 2)], "a long, b long")
    assert sorted(map(tuple, J._more_links(pairs, texts, 4, 85).collect())) == [(1, 4)]
    dropped = []
    monkeypatch.setattr(BitFilter, "drop", lambda self: dropped.append(self))
    J._more_links(pairs, texts, 4, 85)
    assert {1, 2, 4} <= {r.doc_id for r in seen[-1][1].collect()} and seen[-1][1].count() < 30 and dropped
