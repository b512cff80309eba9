"""The join against all pairs of sets, and its pigeonhole against planted differences."""

import random

import numpy as np
import pytest

from tidemark.llm import jaccard
from tidemark.llm.components import components
from tidemark.llm.jaccard import join_similar, most_different, shingles, subsets


def whole(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, whole(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 85 * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def made(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghé") + str(rnd.randrange(300))
    rows = []
    for n in (1, 2, 3, 4, 5, 6, 9, 10, 15, 16, 40, 70, 90, 200, 600):
        for _ in range(2):
            base = [word() for _ in range(n)]
            for _ in range(7):
                own = list(base)
                for _ in range(rnd.randrange(1 + len(own) // 25 + rnd.randrange(2))):
                    at = rnd.randrange(len(own))
                    rnd.choice([lambda: own.__setitem__(at, word()), lambda: own.insert(at, word()), lambda: own.pop(at) if len(own) > 1 else 0])()
                rows.append((rnd.randrange(10 ** 6), " ".join(own).upper() if rnd.random() < 0.3 else "\n".join(own)))
    rows += [(5 * 10 ** 6, None), (5 * 10 ** 6 + 1, ""), (5 * 10 ** 6 + 2, " \n"), (None, rows[3][1]), (None, None), (rows[4][0], rows[100][1]), (rows[4][0], rows[4][1]), (-7, rows[150][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,rounds", [(1, 3), (2, 0)])
def test_against_all_pairs(spark, monkeypatch, seed, rounds):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    rows = made(seed)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, doc string").repartition(3)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, join_similar(docs).collect()), key=key) == sorted(brute(rows), key=key)


def test_no_rows(spark):
    assert join_similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_most_different_is_the_bound():
    for a in range(1, 300):
        for b in range(a, a * 100 // 85 + 2):
            fits = [c for c in range(a + 1) if 100 * c >= 85 * (a + b - c)]
            if fits:
                assert a + b - 2 * min(fits) <= most_different(a + b)


@pytest.mark.parametrize("risk", [0.01, 0.9])
def test_similar_sets_share_a_subset(monkeypatch, risk):
    monkeypatch.setattr(jaccard, "AT_RISK", risk)
    jaccard.scheme.cache_clear()
    rng = np.random.default_rng(7)
    for n in [*range(1, 140), *rng.integers(140, 3000, 150).tolist()]:
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        gone = rng.integers(0, most_different(2 * n) + 1)
        new = rng.integers(0, 2 ** 63, most_different(2 * n) + 2).astype(np.uint64)
        y = rng.choice(x, len(x) - gone, replace=False)
        while len(new) and 100 * len(y) < 85 * (len(x) + len(new)):
            new = new[:-1]
        y = np.unique(np.concatenate([y, new]))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 85 * (len(x) + len(y) - common):
            assert len(np.intersect1d(subsets(x), subsets(y))), n
    jaccard.scheme.cache_clear()


def test_short_texts():
    assert len(shingles("A b")) == 1 and np.array_equal(shingles("A b"), shingles("a\x0bB")) and len(shingles(" ")) == len(shingles(None)) == 0
    assert len(shingles("a b c d")) == 1 and len(shingles("É b c d e")) == 2 and not np.array_equal(shingles("É"), shingles("é"))


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)] + [(700, 700)]
    root = {x: x for e in edges for x in e}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: find(i) for e in edges if e[0] != e[1] for i in e}


def test_similar_sets_share_enough_subsets():
    rng = np.random.default_rng(9)
    for n in rng.integers(64, 1500, 300).tolist():
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        half = most_different(2 * n) // 2
        y = np.unique(np.concatenate([rng.choice(x, n - half, replace=False), rng.integers(0, 2 ** 63, int(rng.integers(0, half + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < 85 * (len(x) + len(y) - common):
            continue
        (a, am, ae, _, _), (b, bm, be, lm, le) = sorted((jaccard.bands(x), jaccard.bands(y)))
        if am:
            least = am - most_different(len(x) + len(y)) - min(ae, be if a == b else le)
            assert len(np.intersect1d(subsets(x), subsets(y))) >= least, n
