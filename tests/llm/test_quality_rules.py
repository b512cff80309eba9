"""Counts of words, lines and windows against plain Python; scores against their definition."""

import re
from collections import Counter

import pytest

from tidemark.llm.quality import score_documents

CLEAN = "the quick brown fox jumps over one lazy dog while seven other foxes watch from the far side of a hill number "
JUNK = "a### b$$$ c%%% d&&& e*** f### g$$$ h%%% i&&& j*** k### l$$$ m%%% n&&& o*** p### q$$$ r%%% s&&& t*** u### v$$$"
ROWS = ([(i, CLEAN + str(i)) for i in range(30)] + [(100 + i, JUNK + str(i)) for i in range(15)] +
        [(200, None), (201, ""), (202, " \n\t"), (203, "one two\x0bthree\x0cfour five six"), (204, "x y\nx y\n\n \nx y\n y"),
         (205, "w1 w2 w3 w4 w5 w6 w7 w8 - w1 w2 w3 w4 w5 w6 w7 w8 w9 w1"), (206, "na " * 400), (207, "<|#|> é€😀 " * 3), (None, CLEAN),
         (208, "long" * 50_000), (208, CLEAN), (208, CLEAN)])


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


@pytest.fixture(scope="module")
def got(spark):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in ROWS], "doc_id long, text string, tokens string, score double")
    trusted = spark.createDataFrame([(i,) for i in range(20)] + [(1,), (None,), (9999,)], "doc_id long")
    return score_documents(docs, trusted).collect()


def test_counts(got):
    key = lambda r: tuple((x is None, x) for x in r)
    have = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]
    assert sorted(have, key=key) == sorted(((i, *counts(t)) for i, t in ROWS), key=key)


def test_verdicts(got):
    by = {r.doc_id: r for r in got}
    assert all(by[i].kept for i in range(30)) and not any(by[100 + i].kept or by[100 + i].base_failed for i in range(15))
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= -0.1)
    assert by[200].score == by[201].score == 0 and by[206].base_failed


def test_nothing_trusted_or_no_rows(spark):
    docs = spark.createDataFrame(ROWS[:3], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert [r.kept for r in score_documents(docs, none).collect()] == [True] * 3
    assert score_documents(docs.limit(0), none).count() == 0
