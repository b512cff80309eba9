"""Vector codes against plain rounds over every entry, in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm.codes import Search, compress

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = []
    for _, v, _ in kept:
        whole = [int(x) * 4096 if abs(x) > 2 ** 52 else math.floor(x * 4096) for x in v] + [0] * (parts * width - len(v))
        cut.append([whole[p * width:(p + 1) * width] for p in range(parts)])
    start = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: kept[k][:2])[:entries]
    if not start:
        return []
    books = [[list(cut[k][p]) for k in start] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min((far(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for v in cut:
                of.setdefault(near(p, v[p])[1], []).append(v[p])
            for k, own in of.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], {}
    for (i, _, g), v in zip(kept, cut):
        found = [near(p, v[p]) for p in range(parts)]
        error = min(sum(f for f, _ in found), 2 ** 63 - 1)
        total[g] = total.get(g, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, g))
    return [(i, c, e, min(total[g], 2 ** 63 - 1), digest) for i, c, e, g in out]


def check(spark, rows):
    df = spark.createDataFrame([(i, v, g, "x", "y") for i, v, g in rows], SCHEMA).repartition(3)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, compress(df).collect()), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_entry(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(10_000), [rnd.choice([rnd.gauss(0, .3), rnd.choice([-.25, 0.0, .25])]) for _ in range(24)], rnd.choice([None, 1, 2, 3])) for _ in range(150)]
    rows += [(i, rows[0][1], 1) for i in range(20_000, 20_060)] + [(20_000, rows[1][1], 2)]
    rows += [(None, rows[2][1], 2), (7, None, 1), (8, [float("nan")] * 24, 1), (9, [None] * 24, None), (10, [1.0] * 23 + [float("-inf")], 1)]
    check(spark, rows)


def test_lengths_that_differ_and_do_not_divide(spark):
    rnd = random.Random(3)
    check(spark, [(i, [rnd.gauss(0, 1) for _ in range(rnd.choice([0, 1, 9, 13]))], None) for i in range(40)])
    check(spark, [(i, [], 1) for i in range(20)])


def test_numbers_beyond_a_long(spark):
    rnd = random.Random(4)
    check(spark, [(i, [rnd.gauss(0, 1) * 10.0 ** rnd.choice([0, 5, 8, 9]) for _ in range(8)], i % 2) for i in range(40)])


def test_few_and_no_rows(spark):
    check(spark, [(1, [.5] * 8, 1), (2, [.25] * 8, 1)])
    check(spark, [(None, [.5] * 8, 1)])
    check(spark, [(1, None, 1)])
    check(spark, [])


def test_candidates_hold_all_within_the_radius():
    rnd = np.random.default_rng(5)
    entries, x = rnd.integers(-50, 50, (100, 3)), rnd.integers(-60, 60, (200, 3))
    radius = rnd.integers(0, 60, 200)
    found = Search.of(entries).candidates(x, radius)
    inside = (np.abs(x[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    assert ((found[:, np.arange(100) // 64] >> (np.arange(100) % 64).astype(np.uint64) & np.uint64(1)) == inside).all()
    label, best = Search.of(entries).nearest(x)
    far = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (label == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
