"""Removal of repeated passages against every window of every text."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import passages
from tidemark.llm.passages import equal_windows, remove_repeats, super_kmers


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for a in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[a:a + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = {j for a in range(len(w) - window + 1) if i is not None and first[tuple(w[a:a + window])] < i for j in range(a, a + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def made(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "b", "c", "é", "The", "the", "x1", "#", "ω"]) + str(rnd.randrange(40))
    passage = [[word() for _ in range(rnd.randrange(6, 40))] for _ in range(6)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(rnd.randrange(4)):
            text += [word() for _ in range(rnd.randrange(12))] + rnd.choice(passage)
        rows.append((i * 3 - 20, " ".join(text).replace(" ", rnd.choice([" ", "\n", " \t ", "\x0b"]))))
    rows += [(500, None), (501, ""), (None, rows[5][1]), (None, None), (rows[7][0], rows[7][1]), (rows[7][0], rows[8][1]), (502, "na " * 700), (503, "na " * 900), (504, rows[9][1] + " " + rows[9][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("frequent", [False, True])
def test_against_every_window(spark, monkeypatch, seed, frequent):
    rows = made(seed)
    if frequent:
        monkeypatch.setattr(passages, "LEAST_FREQUENT", 1)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, packed string").repartition(3)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, remove_repeats(docs, 10).collect()), key=key) == sorted(brute(rows, 10), key=key)


def test_no_rows(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_cover_every_window():
    h = np.random.default_rng(1).integers(0, 2 ** 63, 3000).astype(np.uint64)
    h[1000:2000] = h[1000]
    first, size, low = super_kmers(h, 50)
    assert first[0] == 0 and (first[1:] == (first + size)[:-1]).all() and first[-1] + size[-1] == 2951
    assert size.max() <= passages.LONGEST and len(low) == len(first) < 300


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(passages, "rolling", lambda x, w: np.zeros(max(0, len(x) - w + 1), np.uint64))
    words = pa.array("a b c a b d a b c".split())
    string, place, first = equal_windows(words, np.array([3, 3, 3]), np.array([5, 6, 7]), np.array([5, 6, 7]), 2)
    assert sorted(zip(string.tolist(), place.tolist(), first.tolist())) == [(0, 0, 5), (0, 1, 5), (1, 0, 5), (2, 0, 5), (2, 1, 5)]
