"""SimHash near duplicates against hashing and comparing every pair."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.simhash import fingerprint, near_duplicates, near_links, planes_of, within


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reached(nodes, pairs):
    """The smallest node that each one reaches."""
    least = dict.fromkeys(nodes)
    for n in least:
        least[n] = n
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def brute(rows):
    prints = [(i, plain(t)) for i, t in rows]
    known = [(i, p) for i, p in prints if i is not None]
    pairs = [(i, j) for i, p in known for j, q in known if bin(p ^ q).count("1") <= 2]
    least = reached([i for i, _ in known], pairs)
    return [(i, f"{p:016x}", least.get(i)) for i, p in prints]


def made(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["Wind", "sea", "É", "ox", "The"]) + str(rnd.randrange(60))
    rows = []
    for i in range(40):
        text = [word() for _ in range(rnd.choice([1, 2, 3, 8, 120, 300]))]
        rows.append((i * 7 % 101, rnd.choice([" ", "\n", "\x0b\t"]).join(text)))
        for _ in range(rnd.randrange(4)):
            copy = list(text)
            copy[rnd.randrange(len(copy))] = word()
            rows.append((1000 + len(rows) * 3 % 97, " ".join(copy).upper()))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, rows[3][1]), (None, None), (rows[5][0], rows[8][1]), (rows[5][0], rows[12][1]), (5003, "na " * 100_000), (5004, "x" * 500_000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_every_pair(spark, monkeypatch, seed):
    rows = made(seed)
    if seed == 2:
        monkeypatch.setattr(simhash, "MOST", 2)
    docs = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, fp long, component_id long").repartition(3)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=key) == sorted(brute(rows), key=key)


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("most", [3, 1024])
def test_links_reach_all_that_are_near(spark, monkeypatch, radius, most):
    """Fingerprints around a few centres, in one dense ball and at random."""
    monkeypatch.setattr(simhash, "MOST", most)
    monkeypatch.setattr(simhash, "_HELD", 50)
    rnd = random.Random(radius)
    centres = [rnd.getrandbits(64) for _ in range(12)]
    fps = {rnd.getrandbits(64) for _ in range(60)} | set(centres) | {0, 2 ** 64 - 1}
    for _ in range(200):
        p = rnd.choice(centres)
        for _ in range(rnd.randrange(6)):
            p ^= 1 << rnd.randrange(64)
        fps.add(p)
    fps |= {centres[0] ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(14)}
    fps = sorted(fps)
    rows = [(p - (1 << 64) if p >> 63 else p, d) for d, p in enumerate(fps)]
    links = [tuple(r) for r in near_links(spark.createDataFrame(rows, "fp long, doc long").repartition(4), radius).collect()]
    near = [(i, j) for i, p in enumerate(fps) for j, q in enumerate(fps) if i < j and bin(p ^ q).count("1") <= radius]
    assert reached(range(len(fps)), links) == reached(range(len(fps)), near)
    if most == 1024:
        assert len(links) <= 10 * len(fps)


def test_distances_in_planes():
    rnd = np.random.default_rng(4)
    fps = rnd.integers(0, 2 ** 63, 150).astype(np.uint64)
    fps[40:90] = fps[:50] ^ np.uint64(5)
    planes = planes_of(fps)
    assert ((planes[3][1] >> np.uint64(6)) & np.uint64(1)) == (fps[70] >> np.uint64(3)) & np.uint64(1)
    row, word = (x.reshape(-1) for x in np.meshgrid(np.arange(150), np.arange(3), indexing="ij"))
    valid = np.full(len(row), simhash._ALL)
    valid[word == 2] = np.uint64((1 << 22) - 1)
    for radius in range(4):
        i, j = within(fps, row, word, valid, planes, list(range(64)), radius)
        want = {(a, b) for a in range(150) for b in range(150) if bin(int(fps[a] ^ fps[b])).count("1") <= radius}
        assert set(zip(i.tolist(), j.tolist())) == want


def test_fingerprint_is_sparks_hash(spark):
    assert fingerprint("One word".encode()) == xxhash.xxh64_intdigest(b"one word", 42)
    assert spark.sql("SELECT xxhash64('one word')").first()[0] % 2 ** 64 == fingerprint(b"one word")
