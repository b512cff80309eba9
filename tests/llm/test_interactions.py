"""The filter audit against applying every order of the filters to every document."""

import random
import re
from itertools import permutations

import pytest

from tidemark.llm.interactions import COUNTS, audit_filters, interactions, removal_steps


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in [("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                             ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)), ("D", re.search(r"[#$%&*|]", text))] if bad}


def brute(rows, good, toxic):
    docs = []
    for i, source, text in rows:
        fails = failed(text or "")
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, _, t in rows):
            fails.add("E")
        docs.append((source or "", fails, i in good and i is not None, i in toxic and i is not None))
    out = set()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        told, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                told.append(("".join(order), step, f, len(left), len(gone), sum(f in d[1] for d in mine) - len(gone),
                             sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out |= {(part, o, s, *counts, shapley[f]) for o, s, f, *counts in told}
    return out


def made(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(60):
        words = [rnd.choice(["ab", "Cd", "é", "x#", "yy", "z"]) + (str(rnd.randrange(300)) if rnd.random() < .8 else "") for _ in range(rnd.choice([5, 190, 200, 260]))]
        text = rnd.choice([" ", "\n", "\x0b "]).join(words)
        rows.append((i * 7 % 61, rnd.choice(["web", "book", "", None, "hot", "hot", "hot"]), text.lower() if rnd.random() < .5 else text))
    rows += [(100 + i, "hot", rnd.choice(rows)[2]) for i in range(25)] + [(300 + i, None, None) for i in range(3)]
    rows += [(400, "x", ""), (None, "x", rows[0][2]), (None, "x", None), (rows[1][0], "book", rows[1][2]), (rows[2][0], "web", rows[3][2])]
    rows += [(500, "long", "word " * 300_000), (501, "long", "A" * 2_000_000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_every_order(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame([(i, s, t, 1, True, "q") for i, s, t in rows], "doc_id long, source string, text string, fails int, first boolean, part string").repartition(3)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 0, 1, "x"), (2, 1, None, "x"), (105, None, 1, "x"), (None, 1, 1, "x"), (999, 1, 1, "x"), (300, 1, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    got = audit_filters(docs, labels).select("part", "filter_order", "step", *COUNTS).collect()
    want = brute(rows, {1, 2, 300, 999}, {2, 105, 300, 999})
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert audit_filters(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_other_filters(spark):
    """The report itself serves any few filters."""
    judged = spark.createDataFrame([("p", 0, True), ("p", 3, False), ("p", 2, None)], "part string, fails int, good boolean")
    from pyspark.sql import functions as F
    rows = {(r.filter_order, r.step): r for r in interactions(judged, "xy", F.col("good"), ~F.col("good")).collect()}
    assert set(rows) == {("xy", 1), ("xy", 2), ("yx", 1), ("yx", 2)}
    assert (rows["xy", 1].removed, rows["xy", 2].removed, rows["yx", 1].removed, rows["yx", 2].redundant) == (1, 1, 2, 1)
    assert rows["xy", 1].toxic_lost == 1 and rows["xy", 2].kept == 1 and rows["yx", 1].unique_fails == 1
    assert rows["xy", 1].shapley == 1 and rows["yx", 1].shapley == 3


def test_steps_of_no_or_many_filters():
    with pytest.raises(ValueError):
        removal_steps(0)
    with pytest.raises(ValueError):
        removal_steps(8)
    orders, steps = removal_steps(3)
    assert orders.shape == (6, 3) and (steps[0] == 3).all() and (steps[7] == 0).all()
