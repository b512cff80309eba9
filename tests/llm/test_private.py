"""Base spans against the plain patterns; trees and thresholds on made candidates."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm.private import KINDS, Model, _account, all_spans, base_spans, boosted, find_private, fit, luhn, thresholds, written


def digits(t):
    return re.sub("[^0-9]", "", t)


def brute(t):
    out = [(q.start(), q.end(), "email") for q in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(q.start(), q.end(), "ip") for q in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(v) <= 255 for v in q[0].split("."))]
    out += [(q.start(), q.end(), "card") for q in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(q[0])) <= 19 and luhn(digits(q[0]))]
    out += [(q.start(), q.end(), "phone") for q in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(q[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def test_base_spans_are_the_patterns():
    rnd = random.Random(8)
    parts = ["a@b.com", "@", "x", ".", "1.2.3.4", "255.255.0.256", "+", "4111 1111 1111 1111", "4111111111111111", "-", " ", "(", ")", "é", "+1 (743) 555-3824", "%x@c.org", "0", "12", "1-2", "😀", "a@b", "@b.c", "+1.2", "00300.1.1.1", "4539-1488-0343-6467"]
    for _ in range(4000):
        t = "".join(rnd.choices(parts, k=rnd.randrange(1, 9)))
        assert base_spans(t) == brute(t), t


def test_long_runs_stay_linear():
    for t in ("a" * 300_000 + " @", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 100_000, "1 " * 150_000, "+" + "1(" * 100_000, "(at)" * 60_000, "a at b dot " * 20_000):
        base_spans(t)
        all_spans(t[:60_000], Model(boosted(np.zeros((0, 1), np.int64), np.zeros(0), 0), dict.fromkeys(KINDS, float("inf"))))


def card(rnd):
    d = "4" + "".join(str(rnd.randrange(10)) for _ in range(14))
    return next(d + c for c in "0123456789" if luhn(d + c))


@pytest.fixture(scope="module")
def made(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(900):
        n = rnd.randrange
        body = rnd.choice([f"write to u{n(99)}.n@mail{n(9)}.example.com now", f"host {n(256)}.{n(256)}.{n(256)}.{n(256)} is up", f"pay with {card(rnd)} today", f"call +1 ({n(100, 999)}) 555-{n(1000, 9999)} please", f"order 2020-11-{n(10, 28)} or {n(10 ** 8, 10 ** 9)}", "nothing here"])
        rows.append((i, f"some words {body} and more", "x", "y"))
    rows += [(2000, None, "x", "y"), (2001, "", "x", "y"), (None, "a@b.com", "x", "y"), (2002, "mail to u5.n (at) mail3.example.com today, call (743) 555-3824", "x", "y"), (2002, "version 1.2.3", "x", "y"), (2003, "a@b.com " * 5000, "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, draw string")


def test_query(made):
    model = fit(made)
    rows, texts = find_private(made, model).collect(), [r.text or "" for r in made.collect()]
    assert len(rows) == len(texts)
    for r, t in zip(rows, texts):
        base = brute(t)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in base) for x in KINDS[:4]]
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert {written([b]) for b in base} <= set(r.spans.split(","))
    assert [r.spans for r in rows if r.doc_id == 2002] == ["email:8:35,phone:48:62", ""] and rows[900].spans == ""
    assert all(r.spans == written(brute(t)) for r, t in list(zip(rows, texts))[:900])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = fit(docs)
    assert find_private(docs, model).count() == 0 and all_spans("a@b.com 123 456 789 00", model)[1] == [(0, 7, "email")]


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 8, (2000, 4))
    y = ((x[:, 0] > 3) & (x[:, 2] < 4) | (x[:, 1] == 7)).astype(float)
    trees = boosted(x, y)
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.99
    assert (boosted(x, np.zeros(2000)).margin(x) < -5).all()


def test_thresholds():
    margin, y = np.array([5.0, 4, 3, 2, 1] * 100), np.array([1.0, 1, 1, 0, 0] * 100)
    got = thresholds(margin, y, np.zeros(500, int))
    assert got["email"] == 3 and got["ip"] == float("inf")


def test_account():
    assert _account("DE89 3704 0044 0532 0130 00") and not _account("DE88 3704 0044 0532 0130 00")
