"""Held-out accuracy, what must not count, and the parts against their definitions."""

import zlib

import numpy as np
import pytest

from conftest import SF01
from tidemark.llm.langid import Model, best_temperature, fit, identify, keep_identified, leader, n_grams
from tidemark.llm.queries import op1_langid, table


@pytest.fixture(scope="module")
def model(spark):
    return fit(table(spark, SF01, "documents"))


def test_held_out_accuracy(spark):
    got = op1_langid(spark, SF01).join(table(spark, SF01, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    own = [r for r in got if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in own]) > 0.98 and all(0 <= r.score <= 1 for r in got)


def test_only_text_of_learnable_rows_counts(spark):
    from pyspark.sql import functions as F
    docs = table(spark, SF01, "documents")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    spoiled = docs.select("doc_id", "text", F.when(out, "xx").otherwise(F.col("lang")).alias("lang"))
    a, b = fit(docs, sample=60), fit(spoiled, sample=60)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_odd_texts(spark, model):
    long = "the quick brown fox and the other thing " * 20_000
    rows = [(1, None, "en", "x"), (2, "", None, "x"), (3, "123 ### \n", "en", "x"), (4, "\U0001d41a", None, "x"), (5, long, None, "x"), (None, "the and of", "en", "x"), (6, "the and of", "de", "x"), (6, "the and of", "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score string")
    got = identify(docs, model).collect()
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert got[3].lang_pred in model.languages and got[4].lang_pred == "en"
    assert got[5][1:] == got[6][1:] == got[7][1:] and len(got) == 8
    kept = keep_identified(docs, model, 0.5).collect()
    assert {r.doc_id for r in kept} >= {5, 6} and not {1, 2, 3} & {r.doc_id for r in kept} and kept[0].score == "x"


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    empty = fit(docs)
    assert empty.languages == [] and [r.lang_pred for r in identify(docs, empty).collect()] == ["und", "und"]
    assert identify(docs.limit(0), empty).count() == 0


def test_n_grams_of_a_short_text():
    at, counts = n_grams("Ab--aB")
    assert counts.sum() == 7 + 6 + 5  # blank a b blank a b blank, lower case
    assert np.array_equal(at, n_grams("ab ab")[0]) and set(n_grams("!")[1]) == {1}


def test_leader_is_sparse_and_learns():
    rows = [(np.array([i % 2, 5]), np.array([1.0, 0.2]), i % 2) for i in range(40)] + [(np.array([9]), np.array([0.01]), 1)]
    w = leader(rows, 2)
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 > w[1, 0] and not w[9].any() and not w[100].any()


def test_temperature():
    rng = np.random.default_rng(0)
    s = rng.normal(size=(4000, 3))
    p = np.exp(s) / np.exp(s).sum(axis=1, keepdims=True)
    y = np.array([rng.choice(3, p=q) for q in p])
    assert 2.6 < best_temperature(3 * s, y) < 3.4
    assert Model([], np.ones(1), np.zeros((1, 0))).predict("abc") == ("und", 0.0)
