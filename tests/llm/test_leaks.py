"""Leaks against a scan of every window, on given and planted passages."""

import random

import numpy as np
import pytest

from conftest import SF01
from tidemark.llm.leaks import _answer, bit_masks, common_subsequence, drop_leaks, find_leaks, prepare, terms
from tidemark.llm.queries import table


def plain(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.randrange(1, 9) for _ in range(rnd.randrange(1, 90))] for _ in "ab")
        assert common_subsequence(bit_masks(np.array(a)), len(a), b) == plain(a, b)


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF01, "documents"), table(spark, SF01, "benchmark")


def test_recall_against_every_window(tables):
    docs, benchmark = tables
    got = {(r.doc_id, r.item_id) for r in find_leaks(docs, prepare(docs, benchmark)).collect()}
    items = [(r.item_id, terms(r.text).tolist()) for r in benchmark.collect()]
    want = set()
    for r in docs.collect():
        h = terms(r.text)
        listed, n = h.tolist(), len(h)
        for i, words in items:
            inside = np.cumsum(np.append(0, np.isin(h, np.array(words, np.uint64))))
            wide = len(words) + 2 * max(4, len(words) // 4)
            count = inside[np.minimum(np.arange(n) + wide, n)] - inside[:n]
            masks = bit_masks(np.array(words, np.uint64))
            if any(common_subsequence(masks, len(words), listed[a:a + wide]) >= 0.75 * len(words) for a in np.flatnonzero(count >= 0.75 * len(words))):
                want.add((r.doc_id, i))
    assert len(want) > 10 and len(got & want) >= 0.9 * len(want) and len(got - want) <= 0.02 * len(got) + 1


def test_planted(spark, tables):
    docs, benchmark = tables
    rnd = random.Random(4)
    items = [r for r in benchmark.collect() if len(terms(r.text)) >= 14][:25]
    filler = [r.text for r in docs.limit(60).collect()]
    rows = []
    for k, r in enumerate(items):
        words = r.text.split()
        for at in rnd.sample(range(len(words) // 2), len(words) // 8):
            words[at] = "changed"
        rows.append((k, " ".join([filler[k][:400], " ".join(words).upper(), filler[k + 25][:400]]), "x", 0.5))
    rows += [(100, None, "x", 0.0), (101, "", "x", 0.0), (102, "... !!", "x", 0.0), (None, items[0].text, "x", 0.0), (3, rows[3][1], "x", 0.0),
             (103, " ".join(filler) * 3 + items[1].text + " ".join(filler), "x", 0.0)]
    made = spark.createDataFrame(rows, "doc_id long, text string, item_id string, cosine double")
    blocks = prepare(docs, benchmark.select("text", "item_id"))
    got = [(r.doc_id, r.item_id) for r in find_leaks(made, blocks).collect()]
    hit = {(k, r.item_id) for k, r in enumerate(items)}
    assert len(hit & set(got)) >= 0.9 * len(hit)
    assert (None, items[0].item_id) in got and (103, items[1].item_id) in got and got.count((3, items[3].item_id)) == 2
    kept = drop_leaks(made, blocks).collect()
    assert {100, 101, 102} <= {r.doc_id for r in kept} and len(kept) == len(rows) - sum(any(g[0] == r[0] for g in got) for r in rows)


def test_empty_tables(spark, tables):
    docs, benchmark = tables
    assert find_leaks(docs, prepare(docs, benchmark.limit(0))).count() == 0
    none = docs.limit(0)
    odd = spark.createDataFrame([(1, None), (None, "one two three four five six. seven eight"), (2, "")], "item_id long, text string")
    blocks = prepare(none, odd)
    assert find_leaks(none, blocks).count() == 0
    text = spark.createDataFrame([(7, "and One two, three four five six seven eight then")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in find_leaks(text, blocks).collect()] == [(7, None)]


def test_answer():
    assert len(_answer("What is it? It is a dog.")) == 4 and len(_answer("one two three four five six seven eight")) == 2
