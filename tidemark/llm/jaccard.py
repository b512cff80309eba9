"""Jaccard join of shingle sets by partitions of the universe.

Two sets of sizes a and b with similarity p % or more differ in at most
H = (100 - p) (a + b) // (100 + p) elements. Shingles are hashed into segments, whose number depends on the
sets' size band; by the pigeonhole principle some segment of such a pair holds equal
subsets (H + 1 segments), or subsets one deletion apart (half as many segments). What a set
emits is allocated by cost:

* bands of small sets, where segments would be nearly empty, take few segments and all
  one-deletion neighbours;
* larger bands take one subset for each segment and some spare segments, so that empty
  subsets need not be emitted; a set with more empty segments than spare ones emits the few
  segments with neighbours as well. Two such sets meet there, any other pair among the subsets.

A set emits under its own band and, where a smaller partner can be in it, the band below.
Equal subsets of a task travel once. Sets that share a subset are compared exactly: first each
with the centre it shares most with, then, of subsets that two components still have, each set
with a centre of another component, at last the pairs between components among the sets of
subsets that are still open. Of those only pairs that also share one of their rarest shingles
are compared: similar sets of a and b shingles share C = ceil(p (a + b) / (100 + p)) of them,
so one at least among the a - C + 1 and b - C + 1 rarest. They meet by such a shingle and the
smaller one's size. A set that is nearly, but not quite, similar to a whole group has
about as many shingles of its own as that, so it meets little of the group there.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BitFilter, handing_back, mixed, parts_for, release, rolling, slices, stored, word_hashes
from .components import components

#: Words of a shingle and least similarity where the caller gives none: those of the query.
WORDS = 4
PERCENT = 85
#: A partner of less similarity could be two bands below.
LEAST_PERCENT = 75
#: Growth of the bands, and the size up to which a band takes neighbours only.
GROWTH, SMALL = 1.35, 64
#: Share of a band's sets that may have more empty segments than spare ones.
AT_RISK = 0.01
#: Subsets of a task.
SUBSETS = 1_000_000
#: Tokens that a worker holds at once.
CELLS = 500_000
#: Rounds that compare with centres before pairs between components are compared.
ROUNDS = 3
#: Sets that have a shingle, above each of which it counts as more frequent, and bits of each of the
#: filters that tell so, as a power of two (2 MB).
FREQUENT, FREQUENT_BITS = (1, 8, 64, 1024), 24
#: Sizes up to which each is a class of its own, and growth of the classes beyond.
EXACT_SIZES, SIZE_GROWTH = 200, 1.01


def most_different(both: int, percent: int = PERCENT) -> int:
    """Most elements in which two sets with ``both`` elements together may differ."""
    return (100 - percent) * both // (100 + percent) if both else 0


@lru_cache(1)
def _bounds() -> list[int]:
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * GROWTH)))
    return bounds


@lru_cache(None)
def scheme(band: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """(segments of single subsets or 0, spare ones, segments with neighbours) of a band."""
    low, top = _bounds()[band], _bounds()[band + 1] - 1
    h = most_different(top + top * 100 // percent, percent)
    near = -(-(h + 1) // 2)
    if top < SMALL:
        return 0, 0, near
    def fits(spare: int) -> bool:
        m = h + 1 + spare
        mean = m * math.exp(-low / m)
        steps = np.cumsum(np.log(mean / np.arange(1, spare + 1))) if mean else np.empty(0)
        return 1 - np.exp(np.append(steps, 0.0) - mean).sum() <= AT_RISK

    # by logarithms and halving, as large bands need thousands of spare ones
    top = 0
    while not fits(top):
        top = 2 * top + 1
    spare = bisect_left(range(top), True, key=fits)
    return h + 1 + spare, spare, near


def _salt(band: int, kind: int, m: int, segment: np.ndarray) -> np.ndarray:
    return mixed((np.uint64(((band * 2 + kind) << 40) + m) << np.uint64(8)) + segment.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _segments(ordered: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment of each element, segments with elements, where each begins) of sorted elements."""
    segment = ((ordered >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    return segment, segment[begin], begin


def subsets(ordered: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Hashes of what a set (its sorted, distinct elements) emits."""
    n, out = len(ordered), []
    own = bisect_right(_bounds(), n) - 1
    value = mixed(ordered ^ np.uint64(0x5851F42D4C957F2D))
    for band in (own, own - 1):
        if band < 0 or band < own and 100 * (_bounds()[own] - 1) < percent * n:
            continue
        single, spare, near = scheme(band, percent)
        risk = True
        if single:
            _, used, begin = _segments(ordered, single)
            out.append(mixed(np.add.reduceat(value, begin) + _salt(band, 0, single, used)))
            risk = single - len(used) > spare
        if risk:
            segment, used, begin = _segments(ordered, near)
            total = np.zeros(near, np.uint64)
            total[used.astype(np.int64)] = np.add.reduceat(value, begin)
            salt = _salt(band, 1, near, np.arange(near))
            at = segment.astype(np.int64)
            out += [mixed(total + salt), mixed(total[at] - value + salt[at])]
    return np.unique(np.concatenate(out))


def bands(ordered: np.ndarray, percent: int = PERCENT) -> tuple[int, int, int, int, int]:
    """(band, single segments and empty ones among them, the same under the band below) of a set.

    Of two sets with at most H different elements, at least ``segments - H - empty`` single
    subsets are equal, where ``empty`` is the smaller of their counts of empty ones."""
    own, out = bisect_right(_bounds(), len(ordered)) - 1, []
    for band in (own, own - 1):
        m = scheme(band, percent)[0] if band >= 0 else 0
        out += [m, m - len(_segments(ordered, m)[1]) if m else 0]
    return own, *out


def emits(n: int, stats: tuple[int, int, int, int, int], percent: int = PERCENT) -> int:
    """How many subsets a set of ``n`` elements emits, from its :func:`bands`."""
    own, *rest = stats
    total = 0
    for band, single, empty in ((own, *rest[:2]), (own - 1, *rest[2:])):
        if band < 0 or band < own and 100 * (_bounds()[own] - 1) < percent * n:
            continue
        _, spare, near = scheme(band, percent)
        total += single - empty + (near + n if not single or empty > spare else 0)
    return total


_ZSTD = pa.Codec("zstd", compression_level=1)


def packed(text: str | None) -> bytes:
    """A text as it is stored and shuffled: the size of its UTF-8 in four bytes, and that compressed."""
    raw = (text or "").encode()
    return len(raw).to_bytes(4, "little") + _ZSTD.compress(raw, asbytes=True)


def unpacked(text: bytes) -> bytes:
    return _ZSTD.decompress(text[4:], int.from_bytes(text[:4], "little"), asbytes=True)


def shingles(text: str | bytes | None, width: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct ``width``-word sequences of a text (or one :func:`packed`), A-Z
    lowered; of fewer words the whole sequence as one; none without words."""
    hashes = word_hashes((unpacked(text) if isinstance(text, bytes) else (text or "").encode()).lower())
    n = len(hashes)
    if not n:
        return hashes
    found = rolling(hashes, width) if n >= width else mixed(rolling(hashes, n) + np.uint64(n))
    return np.unique(found)


def _identity(ordered: np.ndarray, doc_id: int) -> tuple[int, int, int]:
    """128 bits of the set, and 64 of the set with its doc_id."""
    import xxhash

    both = np.frombuffer(xxhash.xxh3_128_digest(ordered.tobytes()), np.int64)
    row = mixed(both[:1].view(np.uint64) + np.array([doc_id], np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return int(both[0]), int(both[1]), int(row.view(np.int64)[0])


SETS = "doc_id long, n long, hi long, lo long, row long, band long, own long, own_empty long, low long, low_empty long, emits long"


def _sets(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                s = shingles(text.as_py(), width)
                known = len(s) and doc_id is not None
                rows.append((doc_id, len(s), *(_identity(s, doc_id) if known else (None,) * 3), *((*(b := bands(s, percent)), emits(len(s), b, percent)) if known else (None,) * 6)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [c.split()[0] for c in SETS.split(", ")])
    return run


def _planes(x: np.ndarray) -> bytes:
    """Values by first all their lowest bytes, then the next ones: the upper ones of small values are
    nearly all zeros, which shuffles compress."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplaned(planes: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _steps(ascending: np.ndarray) -> bytes:
    """Ascending unsigned values by their differences, which are small."""
    return _planes(np.diff(ascending, prepend=ascending[:1] * 0))


def _unstepped(steps: bytes, kind) -> np.ndarray:
    return np.cumsum(_unplaned(steps, kind), dtype=kind)


def _emitted(width: int, percent: int, wanted, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                ids, found = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                    s = shingles(text.as_py(), width)
                    if len(s) and doc_id is not None and wanted(np.array([_identity(s, doc_id)[2]]))[0]:
                        ids.append(doc_id)
                        found.append(subsets(s, percent))
                if not ids:
                    continue
                key, doc = np.concatenate(found), np.repeat(np.array(ids, np.int64), [len(f) for f in found])
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                first = np.concatenate([[True], key[1:] != key[:-1]])
                more = ~first | np.append(~first[1:], False)  # this task alone has the subset twice
                target = ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                rows = []
                for shared, rows_of, to in ((False, np.flatnonzero(first), target), (True, np.flatnonzero(more), (doc.view(np.uint64) % np.uint64(parts)).astype(np.int64))):
                    rows_of = rows_of[np.argsort(to[rows_of], kind="stable")]
                    edges = np.searchsorted(to[rows_of], np.arange(parts + 1))
                    rows += [(p, shared, _steps(key[r]), _planes(doc[r])) for p, a, b in zip(range(parts), edges, edges[1:]) if b > a and (r := rows_of[a:b]) is not None]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.bool_(), pa.binary(), pa.binary()))], ["part", "shared", "keys", "docs"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(key, doc):
        for a in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[a:a + 100_000].view(np.int64)), pa.array(doc[a:a + 100_000])], ["subset", "doc"])

    keys, docs = [], []
    for batch in batches:
        for shared, k, d in zip(batch.column("shared").to_pylist(), batch.column("keys").to_pylist(), batch.column("docs").to_pylist()):
            k, d = _unstepped(k, "<u8"), _unplaned(d, "<i8")
            if shared:
                yield from rows(k, d)
            else:
                keys.append(k)
                docs.append(d)
    if keys:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        same = np.concatenate([[False], key[1:] == key[:-1], [False]])
        more = same[1:] | same[:-1]
        yield from rows(key[more], doc[more])


def _mixed_ids(ids: pa.Array) -> np.ndarray:
    return mixed(np.asarray(ids.cast(pa.int64()).fill_null(0)).view(np.uint64))


def _texts(wanted):
    """Those rows (doc_id, text) whose doc_id is wanted, with texts packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(wanted(_mixed_ids(batch.column("doc_id"))) & np.asarray(batch.column("doc_id").is_valid()), pa.bool_()))
            texts = [t if isinstance(t, bytes) else packed(t) for t in (t.as_py() for t in some.column("text"))]
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])
    return run


TEXTS = "doc_id long, text binary"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_mixed_ids(batch.column("doc")).view(np.int64))], ["key"])


def _compared(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for a, b, s, t in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("s"), batch.column("t")):
                x, y = shingles(s.as_py(), width), shingles(t.as_py(), width)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar."""
    rows = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("s")), "a")
    rows = rows.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t")), "b")
    return rows.select("a", "b", "s", "t").mapInArrow(handing_back(_compared(width, percent)), "a long, b long").distinct()


def _more_links(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The same, stored; of ``texts`` only those of ``pairs`` are dealt out."""
    ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
    wanted = BitFilter(pairs.sparkSession, ids.mapInArrow(_hashed, "key long"))
    links = stored(_links(pairs, texts.mapInArrow(_texts(wanted.test()), TEXTS), width, percent), "more-links")
    wanted.drop()
    return links


def _labelled(shared: DataFrame, label: DataFrame) -> DataFrame:
    """``shared`` (subset, doc) with ``label``, of those subsets that two components have."""
    label = label.select(F.col("node").alias("doc"), "component")
    rows = shared.join(label, "doc", "left").select("subset", "doc", F.coalesce("component", "doc").alias("label"))
    two = rows.groupBy("subset").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return stored(rows.join(two, "subset"), "open-subsets")


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _frequencies(width: int, parts: int, wanted):
    """How many of a task's wanted sets have a token of each cell: cells are the tokens' upper 32 bits,
    which is more than filters look at."""
    def sent(found: list[np.ndarray]) -> pa.RecordBatch:
        cells, n = np.unique(np.concatenate(found), return_counts=True)
        n = np.minimum(n, 0xFFFF).astype("<u2")
        edges = np.searchsorted((cells.astype(np.uint64) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1))
        rows = [(p, _steps(cells[a:b]), n[a:b].tobytes()) for p, a, b in zip(range(parts), edges, edges[1:]) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], ["part", "cells", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for text in batch.column("text").filter(pa.array(wanted(_mixed_ids(batch.column("doc"))), pa.bool_())):
                found.append((shingles(text.as_py(), width) >> np.uint64(32)).astype("<u4"))
                size += len(found[-1])
                if size > CELLS:
                    yield sent(found)
                    found, size = [], 0
        if size:
            yield sent(found)
    return run


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) of cells that more than one set has, by the first token that a cell can hold."""
    cells, n = [], []
    for batch in batches:
        cells += [_unstepped(x, "<u4") for x in batch.column("cells").to_pylist()]
        n += [np.frombuffer(x, "<u2") for x in batch.column("n").to_pylist()]
    if cells:
        cell, n = np.concatenate(cells), np.concatenate(n)
        order = np.argsort(cell, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(cell[order]) != 0))
        cell, n = cell[order][begin], np.add.reduceat(n[order].astype(np.int64), begin)
        token, n = cell[n > 1].astype(np.uint64) << np.uint64(32), n[n > 1]
        for a in range(0, len(n), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(token[a:a + 100_000].view(np.int64)), pa.array(n[a:a + 100_000])], ["token", "n"])


@lru_cache(1)
def _sizes() -> list[int]:
    """The least size of each class of sizes."""
    sizes = list(range(1, EXACT_SIZES + 1))
    while sizes[-1] < 1 << 40:
        sizes.append(max(sizes[-1] + 1, int(sizes[-1] * SIZE_GROWTH)))
    return sizes


def rarest(ordered: np.ndarray, above, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys by which a set meets larger (or equal) and smaller (or equal) similar ones: hashes of one
    of its rarest elements, of those that another set has, with the smaller set's class of size.

    ``above`` tells, class by class, whether elements count as more frequent; it is the same for
    all sets, so that class and value give one order of all elements."""
    n = len(ordered)
    frequency = np.zeros(n, np.int64)
    for more in above:
        frequency += more(ordered)
    first = np.argsort(frequency, kind="stable")
    ranked, own = ordered[first], int((frequency == 0).sum())  # elements of no other set come first
    prefix = lambda other: n + (-percent * (n + other)) // (100 + percent) + 1
    key = lambda tokens, size: mixed(tokens + np.array([size], np.uint64) * np.uint64(0xA24BAED4963EE407))
    least = max(1, -(-percent * n // 100))
    low, high = (bisect_right(_sizes(), x) - 1 for x in (least, n))
    larger = key(ranked[own:max(own, prefix(n))], high)
    smaller = [key(ranked[own:max(own, prefix(max(least, _sizes()[c])))], c) for c in range(low, high + 1)]
    return larger, np.concatenate(smaller)


def _rarest(width: int, percent: int, above):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                found = [rarest(shingles(t.as_py(), width), above, percent) for t in part.column("text")]
                for side, name in ((0, "larger"), (1, "smaller")):
                    count = [len(f[side]) for f in found]
                    columns = [np.concatenate([f[side] for f in found]).view(np.int64), *(np.repeat(np.asarray(part.column(c)), count) for c in ("doc", "label"))]
                    for a in range(0, sum(count), 100_000):
                        some = [pa.array(c[a:a + 100_000]) for c in columns]
                        yield pa.RecordBatch.from_arrays([*some, pa.array([name] * len(some[0]), pa.string())], ["token", "doc", "label", "meets"])
    return run


RARE = "token long, doc long, label long, meets string"


def _meeting(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted(np.asarray(batch.column("token")))))
    return run


def _ends(token: np.ndarray, low: np.ndarray, high: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, ...]:
    """(token, its lowest and highest label, its sides) of each token, ascending."""
    order = np.argsort(token, kind="stable")
    token = token[order]
    begin = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.empty(0, np.int64)
    if not len(begin):
        return token, low, high, sides
    return token[begin], np.minimum.reduceat(low[order], begin), np.maximum.reduceat(high[order], begin), np.bitwise_or.reduceat(sides[order], begin)


def _sided(parts: int):
    """What the tokens of RARE rows meet, a row for each part of them."""
    def sent(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        token, label, sides = (np.concatenate(c) for c in zip(*found))
        token, low, high, sides = _ends(token, label, label, sides)
        edges = np.searchsorted(((token >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1))
        rows = [(p, _steps(token[a:b]), _planes(low[a:b]), _planes(high[a:b] - low[a:b]), sides[a:b].tobytes()) for p, a, b in zip(range(parts), edges, edges[1:]) if b > a]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), *(pa.binary(),) * 4))], ["part", "tokens", "low", "more", "sides"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            larger = np.asarray(pa.compute.equal(batch.column("meets"), "larger"))
            found.append((np.asarray(batch.column("token")).view(np.uint64), np.asarray(batch.column("label")), np.where(larger, 1, 2).astype(np.uint8)))
            size += batch.num_rows
            if size > CELLS // 4:
                yield sent(found)
                found, size = [], 0
        if found:
            yield sent(found)
    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of two labels and both sides."""
    found = []
    for batch in batches:
        for tokens, low, more, sides in zip(*(batch.column(c).to_pylist() for c in ("tokens", "low", "more", "sides"))):
            low = _unplaned(low, "<i8")
            found.append((_unstepped(tokens, "<u8"), low, low + _unplaned(more, "<i8"), np.frombuffer(sides, np.uint8)))
    if found:
        token, low, high, sides = _ends(*(np.concatenate(c) for c in zip(*found)))
        token = token[(low < high) & (sides == 3)].view(np.int64)
        for a in range(0, len(token), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(token[a:a + 100_000])], ["token"])


def _open_pairs(rows: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among the sets of open subsets ``rows`` (doc, label) that
    share one of their rarest shingles: all similar ones are among them."""
    spark = rows.sparkSession
    texts, labels = texts.withColumnRenamed("doc_id", "doc"), rows.select("doc", "label").distinct()
    # some other texts may be counted too: any counts give one order of all shingles
    opened = BitFilter(spark, rows.select("doc").mapInArrow(_hashed, "key long"))
    parts = parts_for(spark, texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0, 4 * CELLS)
    cells = texts.select("doc", "text").mapInArrow(handing_back(_frequencies(width, parts, opened.test())), "part long, cells binary, n binary")
    counts = stored(cells.repartition(parts, "part").mapInArrow(handing_back(_frequent), "token long, n long"), "frequent-tokens")
    opened.drop()
    above = [BitFilter(spark, counts.where(F.col("n") > n).select("token"), FREQUENT_BITS) for n in FREQUENT]
    tokens = stored(texts.join(labels, "doc").mapInArrow(handing_back(_rarest(width, percent, [f.test() for f in above])), RARE), "rare-tokens")
    for f in above:
        f.drop()
    release(spark)
    parts = parts_for(spark, tokens.count(), CELLS)
    sides = tokens.select("token", "label", "meets").mapInArrow(handing_back(_sided(parts)), "part long, tokens binary, low binary, more binary, sides binary")
    two = stored(sides.repartition(parts, "part").mapInArrow(handing_back(_met), "token long"), "meeting-tokens")
    # of the many rows only those that may meet another are dealt out for the joins
    meeting = BitFilter(spark, two)
    tokens = stored(tokens.mapInArrow(_meeting(meeting.test()), RARE), "meeting-rows").join(two, "token")
    meeting.drop()
    x, y = (tokens.where(F.col("meets") == m).select("token", F.col("doc").alias(n), F.col("label").alias(f"label_{n}")) for n, m in (("x", "larger"), ("y", "smaller")))
    return _ordered(x.join(y, "token").where("label_x <> label_y").select("x", "y"))


def join_similar(docs: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of each of ``docs`` (doc_id, text): two documents link
    when the similarity of their sets of ``width``-word shingles is ``percent`` or more; the component is the smallest doc_id
    reachable by links.

    A null or blank text has an empty set and is linked with nothing. A row without doc_id is
    linked with nothing and has no component. Rows that repeat a doc_id are one document
    with several sets. Other columns are left aside. An empty table gives no rows.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent is {percent}, not between {LEAST_PERCENT} and 100")
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    sets = stored(docs.mapInArrow(handing_back(_sets(width, percent)), SETS), "sets")
    # one document of each distinct set goes on
    classes = stored(sets.where("hi is not null").groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "row", "emits")).alias("first")).select("hi", "lo", F.col("first.doc_id").alias("doc"), "first.row", "first.emits"), "classes")
    of = sets.join(classes.drop("row", "emits"), ["hi", "lo"], "left").select("doc_id", "n", "doc")
    several = of.where("doc is not null").groupBy("doc_id").agg(F.min("doc").alias("x"), F.max("doc").alias("y")).where("x < y")
    several = of.join(several, "doc_id").select(F.col("doc").alias("x"), F.col("x").alias("y"))
    parts = parts_for(spark, classes.agg(F.sum("emits")).first()[0] or 0, SUBSETS)
    first = BitFilter(spark, classes.select("row"))
    emitted = docs.mapInArrow(handing_back(_emitted(width, percent, first.test(), parts)), "part long, shared boolean, keys binary, docs binary")
    shared = stored(emitted.repartition(parts, "part").mapInArrow(handing_back(_shared), "subset long, doc long").distinct(), "shared-subsets")
    first.drop()
    release(spark)
    near = shared.select("doc").distinct()
    near_ids = BitFilter(spark, near.mapInArrow(_hashed, "key long"))
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_texts(near_ids.test()), TEXTS), "near-texts")
    near_ids.drop()
    centres = shared.groupBy("subset").agg(F.min("doc").alias("y"))
    most = (shared.join(centres, "subset").where("doc <> y").groupBy("doc", "y").count()
            .groupBy("doc").agg(F.max(F.struct("count", -F.col("y"))).alias("best")))
    pairs = stored(_ordered(most.select(F.col("doc").alias("x"), (-F.col("best.col2")).alias("y"))), "pairs")
    links = stored(_ordered(several).unionByName(_links(pairs, texts, width, percent)), "links")
    release(spark)
    label, turn = components(links), 0
    rows = _labelled(shared, label)
    while turn <= ROUNDS and not rows.isEmpty():
        if turn < ROUNDS:
            ends = rows.groupBy("subset").agg(F.min(F.struct("label", "doc")).alias("low"), F.max(F.struct("label", "doc")).alias("high"))
            both = rows.select("subset", "doc", "label").join(ends, "subset")
            new = _ordered(both.select(F.col("doc").alias("x"), F.when(F.col("label") == F.col("low.label"), F.col("high.doc")).otherwise(F.col("low.doc")).alias("y")))
        else:
            new = _open_pairs(rows, texts, width, percent)
        new = stored(new.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
        grown = not new.isEmpty()
        if grown:
            links = _more_links(new, texts, width, percent)
            pairs, grown = pairs.unionByName(new), not links.isEmpty()
        if not grown:  # the components, and so their centres, stay: only the pairs between them are left
            turn = ROUNDS if turn < ROUNDS else ROUNDS + 1
            continue
        release(spark)
        label = components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))
        turn += 1
        if turn <= ROUNDS:
            rows = _labelled(shared, label)
    label = label.select(F.col("node").alias("doc"), "component")
    return of.join(label, "doc", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id")).alias("component_id"))
