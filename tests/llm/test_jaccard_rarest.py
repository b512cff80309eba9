"""The counts and the last filter of the join: what a set emits, and which pairs are left to compare."""

import random

import numpy as np
import pytest

from tidemark.llm import jaccard
from tidemark.llm.jaccard import bands, emits, join_similar, rarest, subsets


@pytest.mark.parametrize("percent", [80, 85])
def test_emitted_subsets_are_counted(percent):
    rng = np.random.default_rng(percent)
    for n in (1, 2, 5, 30, 63, 64, 90, 150, 400, 3000):
        s = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2))
        assert len(subsets(s, percent)) == emits(len(s), bands(s, percent), percent)


@pytest.mark.parametrize("percent", [80, 85])
def test_similar_sets_share_one_of_their_rarest(percent):
    rnd = random.Random(percent)
    for _ in range(300):
        n = rnd.choice([rnd.randrange(1, 60), rnd.randrange(200, 900)])
        a = rnd.sample(range(2000), n)
        b = [x for x in a if rnd.random() < .95] + [rnd.randrange(2000, 3000) for _ in range(rnd.randrange(1 + n // 15))]
        a, b = set(a), set(b)
        if not b or 100 * len(a & b) < percent * len(a | b):
            continue
        often = {x for x in range(3000) if rnd.random() < .5} | (a & b)
        above = [lambda v: np.isin(v, list(often)), lambda v: v % 3 == 0]
        small, large = (rarest(np.array(sorted(s), np.uint64), above, percent) for s in sorted((a, b), key=len))
        assert set(small[0].tolist()) & set(large[1].tolist()), (a, b)


def plain(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))}
    least = {i: i for i in sets}
    pairs = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for _ in sets:
        before = dict(least)
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
        if before == least:
            return least


@pytest.mark.parametrize("rounds", [0, 3])
def test_a_group_that_is_nearly_similar_enough(spark, monkeypatch, rounds):
    """Many variants of one text between 0.6 and 0.95; without rounds the last filter tells all."""
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(4000)}" for _ in range(160)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rnd.sample(range(160), rnd.choice([1, 2, 3, 5, 8, 12, 16])):
            words[at] = f"v{rnd.randrange(10 ** 6)}"
        rows.append((i * 3 % 127, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in join_similar(docs).collect()}
    want = plain(rows, 4, 85)
    assert got == want and len(set(want.values())) > 5


def test_sets_far_from_a_group_meet_none_of_it(spark):
    """Candidates of the last filter don't grow with the square of such a group."""
    rnd = random.Random(6)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(200):
        words = list(base)
        for at in rnd.sample(range(0, 200, 4), 12):  # a quarter of the shingles or so
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words), i))
    some = spark.createDataFrame(rows, "doc_id long, text string, label long")
    pairs = jaccard._open_pairs(some.select(some.doc_id.alias("doc"), "label"), some.select("doc_id", "text"), 4, 85)
    assert pairs.count() == 0
