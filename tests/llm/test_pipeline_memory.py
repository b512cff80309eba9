"""What the pipeline's stages leave in executors and their Python workers is bounded."""

import numpy as np

import corpus_pipeline as P
from conftest import SF001
from tidemark.llm import jaccard as J
from tidemark.llm import packing
from tidemark.llm.leaks import fit_projection, terms
from tidemark.llm.queries import vocabulary


def _word(k):
    return "".join(chr(97 + k // 26 ** i % 26) for i in range(5))


def test_worker_keeps_few_words():
    encode = packing.WordIds(vocabulary())
    first = encode(["frequent", _word(0)])
    for a in range(0, 400_000, 50_000):
        assert encode(["frequent", *(_word(k) for k in range(a, a + 50_000))])[:1] == first[:1]
    assert len(encode.known) + len(encode.older) <= 300_000
    assert encode(["frequent", _word(0)]) == first


def test_filters_are_dropped(spark, monkeypatch):
    made, dropped = [], []
    make, drop = J.BitFilter.__init__, J.BitFilter.drop
    monkeypatch.setattr(J.BitFilter, "__init__", lambda self, *a: made.append(self) or make(self, *a))
    monkeypatch.setattr(J.BitFilter, "drop", lambda self: dropped.append(self) or drop(self))
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "other words than these here")], "doc_id long, text string")
    rows = J.join_similar(docs)
    assert made and dropped == made
    assert sorted((r.doc_id, r.component_id) for r in rows.collect()) == [(1, 1), (2, 1), (3, 3)]


def test_projection_needs_no_rdd_of_python(spark, monkeypatch):
    docs = P.table(spark, SF001, "documents")
    items = [terms("one two three four five six seven"), terms("eight nine ten")]
    want = fit_projection(docs, items)
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", None)
    assert np.allclose(np.abs(fit_projection(docs, items)), np.abs(want), atol=1e-2)


def test_only_tokens_that_meet_are_dealt_out(spark, monkeypatch):
    kept, stored = {}, J.stored
    monkeypatch.setattr(J, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    texts = [(k, 1, f"{a} end{k}") for k in range(1, 6)] + [(k, 9, f"{b} end{k}") for k in range(9, 14)] + [(20, 20, f"{a} end20")]
    some = spark.createDataFrame(texts, "doc_id long, label long, text string")
    pairs = J._open_pairs(some.select(some.doc_id.alias("doc"), "label"), some.select("doc_id", "text"), 4, 85)
    assert sorted(map(tuple, pairs.collect())) == [(k, 20) for k in range(1, 6)]
    docs = lambda name: {r.doc for r in kept[name].collect()}
    assert docs("rare-tokens") >= set(range(9, 14)) and docs("meeting-rows") == {*range(1, 6), 20}
