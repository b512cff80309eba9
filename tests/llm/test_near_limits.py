"""The join and the pipeline's stage under other limits than the query's, against all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm.jaccard import join_similar, scheme, subsets


def brute(rows, width, percent):
    sets, root = [], {i: i for i, _ in rows}
    for i, t in rows:
        w = t.split()
        sets.append((i, {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))}))

    def find(i):
        return i if root[i] == i else find(root[i])

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, len(s), find(i)) for i, s in sets]


def test_pipeline_limits_against_all_pairs(spark):
    rnd, rows = random.Random(4), []
    for n in (5, 6, 9, 14, 25, 40, 60, 90, 200, 500):
        for group in range(3):
            base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]
            for part in range(8):
                own = base + [f"w{rnd.randrange(10 ** 6)}" for _ in range(n * part // 32)] if part % 2 else base[n * part // 32:]
                for _ in range(rnd.randrange(2) * (n // 50)):
                    own = [*own[:(at := rnd.randrange(len(own)))], "other", *own[at + 1:]]
                rows.append((len(rows), " ".join(own)))
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = brute(rows, 5, 80)
    assert sorted(map(tuple, join_similar(docs, 5, 80).collect())) == sorted(want)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {c for *_, c in want}
    assert {c for *_, c in want} != {c for *_, c in brute(rows, 5, 85)}


def test_similar_sets_share_a_subset_at_80():
    rng = np.random.default_rng(8)
    for n in [*range(1, 140), *rng.integers(140, 3000, 150).tolist()]:
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        for more, less in ((n // 4, 0), (0, n // 5), (n // 9, n // 9)):
            y = np.unique(np.concatenate([rng.choice(x, n - less, replace=False), rng.integers(0, 2 ** 63, more).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common >= 80 * (len(x) + len(y) - common):
                assert len(np.intersect1d(subsets(x, 80), subsets(y, 80))), n


def test_percent_out_of_range(spark):
    with pytest.raises(ValueError, match="percent"):
        join_similar(spark.createDataFrame([], "doc_id long, text string"), 5, 60)


@pytest.mark.parametrize("percent", [80, 85])
def test_long_texts(percent):
    rng = np.random.default_rng(10)
    for n in (20_000, 60_000, 400_000):
        x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        y = np.sort(rng.choice(x, n * percent // 100 + 1, replace=False))
        assert len(np.intersect1d(subsets(x, percent), subsets(y, percent)))
    assert all(m > spare >= 0 for m, spare, _ in (scheme(b, percent) for b in range(20, 48)))
