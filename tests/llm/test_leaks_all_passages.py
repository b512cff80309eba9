"""The projection is fitted on all passages of all documents, and on all items."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import leaks
from tidemark.llm.common import placed_hashes, word_hashes
from tidemark.llm.leaks import _added, _bucket, _cut, _sums, fit_projection, prepare, terms, words_of


def test_singular_values_of_all_passages(spark):
    n = 100_000  # passages of three words, 30 in all
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.concat(F.lit(f"{c}x"), F.pmod(F.xxhash64("id", F.lit(c)), F.lit(10)).cast("string")) for c in "abc")).alias("text"))
    words = [[r.text.split() for r in docs.collect()], ["ax0 bx1 cx2 ax0".split()]]
    names = sorted({w for x in words[0] for w in x})
    at = {w: k for k, w in enumerate(names)}
    a = np.zeros((n + 1, len(names)))
    for k, x in enumerate(words[0] + words[1]):
        for w in x:
            a[k, at[w]] += 1
    idf = np.log((1 + n) / (1 + (a[:n] > 0).sum(axis=0))) + 1
    a *= idf
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    want = np.linalg.svd(a.T @ a)[1] ** .5
    projection = fit_projection(docs, [terms(" ".join(words[1][0]))])
    own = np.array([_bucket(terms(w))[0] for w in names])
    assert len(set(own.tolist())) == len(names) and not np.delete(projection, own, axis=0).any()
    got = 1 / np.linalg.norm(projection[own] / idf[:, None], axis=0)
    assert np.allclose(got, want[want > want[0] * 1e-2], rtol=1e-3)


def test_all_items_are_fitted_on(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(leaks, "ITEMS", 3)
    monkeypatch.setattr(leaks, "fit_projection", lambda docs, items: seen.append(len(items)) or np.ones((leaks.SIZE, 2), np.float32))
    benchmark = spark.createDataFrame([(k, f"what is item number {k} in this list") for k in range(10)], "item_id long, text string")
    assert len(prepare(None, benchmark)) == 4 and seen == [10]


@pytest.mark.parametrize("n", (1, 7, 8, 9, 5000))
def test_sums_by_key(n):
    rng = np.random.default_rng(n)
    rows = rng.normal(size=(50, 6)).astype(np.float32)
    keys, at = np.sort(np.minimum(rng.zipf(1.3, n), 300)), rng.integers(0, 50, n)
    got, sums = _sums(keys, at, rows)
    assert np.array_equal(got, np.unique(keys))
    assert np.allclose(sums, [rows[at[keys == k]].sum(axis=0) for k in got], rtol=1e-3, atol=1e-3)
    assert np.allclose(_added(rows, at.reshape(-1, 1)), rows[at])


def test_passages_of_texts():
    texts = ["", " ".join(f"w{k}" for k in range(95)), None, "one two one", " ".join(f"v{k}" for k in range(40))]
    rows = _cut(*words_of(texts))
    want = [x[a:a + leaks.PASSAGE] for x in (_bucket(terms(t)) for t in texts) for a in range(0, len(x), leaks.PASSAGE)]
    assert [[b for b in r if b < leaks.SIZE] for r in rows.tolist()] == [sorted(w.tolist()) for w in want]


def test_words_by_their_bytes():
    words = ["x" * n + end for n in (0, 1, 7, 8, 9, 15, 16, 63, 127, 128, 129, 136, 400) for end in "abé"]
    raw = "\n".join(words).encode()
    h, starts = placed_hashes(raw)
    assert len(set(h.tolist())) == len(words) and np.array_equal(np.concatenate([word_hashes(f" {w}\t".encode()) for w in words]), h)
    assert [raw[a:].split()[0].decode() for a in starts] == words
    long = b" ".join([raw] * 100)  # several blocks
    again, starts = placed_hashes(long)
    assert np.array_equal(again, np.tile(h, 100)) and [long[a:a + 1] for a in starts] == [w.encode()[:1] for w in words] * 100


def test_the_pipeline_fits_on_all_documents_and_items(spark, monkeypatch):
    import corpus_pipeline as P
    from conftest import SF001
    docs, seen, stored = P.table(spark, SF001, "documents"), [], leaks.stored
    monkeypatch.setattr(leaks, "ITEMS", 3)
    monkeypatch.setattr(leaks, "stored", lambda df, name: seen.append(stored(df, name)) or seen[-1])
    fit = leaks.fit_projection
    monkeypatch.setattr(leaks, "fit_projection", lambda docs, items: seen.append(len(items)) or fit(docs, items))
    P.decontamination(spark, docs, SF001)
    items, passages = seen
    rows = [r.passages for r in passages.collect()]
    assert items == P.table(spark, SF001, "benchmark").count() > 3
    assert sum(len(r) for r in rows) == sum(-(-len(terms(r.text)) // leaks.PASSAGE) for r in docs.collect()) * leaks.PASSAGE * 2
    assert max(map(len, rows)) <= leaks.STORED * leaks.PASSAGE * 2
