"""Items of a few words, paraphrases at the lowest share, and more items than one block holds."""

import random

import numpy as np
import pytest

from conftest import SF01
from tidemark.llm import leaks
from tidemark.llm.leaks import drop_leaks, find_leaks, leaks_of, prepare, terms, words_of
from tidemark.llm.queries import table


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF01, "documents"), table(spark, SF01, "benchmark")


def test_short_items_are_found_word_by_word(spark, tables):
    docs, _ = tables
    items = {1: "Zyxomma!", 2: "quor blint", 3: "Vexil, dray plome", 4: "ulm ork ist ferne", 5: "one two three four blint", 6: "quor blint"}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    filler = [r.text for r in docs.where("lang = 'en'").limit(20).collect()]
    around = lambda k, x: f"{filler[k][:300]} {x} {filler[k + 5][:300]}"
    rows = [(k, around(k, t.upper())) for k, t in items.items()]
    rows += [(20, around(1, "quor and blint")), (21, "quor"), (22, "blint"), (23, "dray plome vexil"), (24, "ulm ork ist"), (25, "Quor, blint")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = prepare(docs, benchmark)
    got = {(r.doc_id, r.item_id): r.common for r in find_leaks(made, blocks).collect()}
    assert got == {**{(k, k): 1.0 for k in items}, (2, 6): 1.0, (6, 2): 1.0, (25, 2): 1.0, (25, 6): 1.0}
    assert {r.doc_id for r in drop_leaks(made, blocks).collect()} == {20, 21, 22, 23, 24}


def test_paraphrases_at_the_lowest_share(spark, tables):
    """A share of 0.55 to 0.75 of the words in order, with the answer: recall against the rule itself."""
    docs, benchmark = tables
    rnd = random.Random(6)
    filler = [r.text for r in docs.where("lang = 'en'").limit(80).collect()]
    rows, want = [], set()
    for k, r in enumerate(x for x in benchmark.collect() if len(terms(x.text)) >= 14):
        words, answer = r.text.split(), len(leaks._answer(r.text))
        free = range(len(words) - answer)
        gone = set(rnd.sample(free, min(len(free), int(len(words) * rnd.uniform(.27, .42)))))
        kept = [w for i, w in enumerate(words) if i not in gone]
        own = {w.lower() for w in words}
        share = sum(len(terms(w)) for w in kept) / len(terms(r.text))
        if .55 <= share < .75 and own:
            rows.append((k, " ".join([filler[k % 80][:300], " ".join(kept), filler[(k + 40) % 80][:300]])))
            want.add((k, r.item_id))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(made, prepare(docs, benchmark)).collect()}
    assert len(want) >= 30 and len(got & want) >= 0.9 * len(want)


def test_more_items_than_a_block(tables, monkeypatch):
    docs, benchmark = tables
    whole = {(r.doc_id, r.item_id) for r in find_leaks(docs, prepare(docs, benchmark)).collect()}
    monkeypatch.setattr(leaks, "ITEMS", 30)
    blocks = prepare(docs, benchmark)
    assert len(blocks) > 1 and sum(len(b.ids) for b in blocks) == benchmark.count()
    some = {(r.doc_id, r.item_id) for r in find_leaks(docs, blocks).collect()}
    assert len(some & whole) >= 0.9 * len(whole) and len(some - whole) <= 0.1 * len(whole)


def test_texts_keep_apart():
    """Neither words nor windows run from one text into the next, whatever lies between them."""
    texts = [None, "", "Ab c", "...", "d", " \n", "e f!"]
    h, borders = words_of(texts)
    assert np.array_equal(h, np.concatenate([terms(t) for t in texts])) and borders.tolist() == [0, 0, 0, 2, 2, 3, 3, 5]
    rng = np.random.default_rng(1)
    projection = rng.normal(size=(leaks.SIZE, 8)).astype(np.float32)
    item = " ".join(f"word{i}" for i in range(20))
    q = leaks.Queries([7], [terms(item)], [terms("word18 word19")], projection)
    apart = [item[:len(item) // 2], item[len(item) // 2:], None, item, "x " * 3000 + item + " y" * 3000, item]
    assert [t for t, *_ in leaks_of(apart, q)] == [3, 4, 5] and all(x[1:] == (7, *x[2:]) and x[3] == 1.0 for x in leaks_of(apart, q))
