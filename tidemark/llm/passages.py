"""Repeated passages: every word covered by a window of fifty words that also starts in a
document with a smaller id.

Consecutive windows with the same minimiser travel as one packed string (a super-k-mer) to
that minimiser's bucket, where sorting finds equal windows and compares them word by word.
Only minimisers that occur in two documents or more travel. Equal strings of a task
travel once, without their places; what a bucket finds out about a string is joined back
to its places by the string's hash, so a passage that a third of the documents share costs a
row for each task, not for each document. Windows of very frequent minimisers travel one by
one, each to a bucket of its own hash; a filter of fixed size tells which these are, and
if it takes another minimiser for one, so it does in every document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BitFilter, parts_for, rolling, slices, stored, word_hashes

WINDOW = 50
#: Words of a minimiser.
MINIMISER = 8
#: Windows that one string holds at most; a longer run goes on in the next string.
LONGEST = 256
#: Strings to a task, and strings above which a minimiser is frequent, whatever the corpus.
STRINGS, LEAST_FREQUENT = 20_000, 20_000
#: Bits of the filter of frequent minimisers, as a power of two: 2 MB.
FREQUENT_BITS = 24


def super_kmers(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimiser) of runs of windows with the same minimiser."""
    m = min(MINIMISER, window)
    low, width, w = rolling(hashes, m), window - m + 1, 1
    if len(low) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    while 2 * w <= width:
        low, w = np.minimum(low[:-w], low[w:]), 2 * w
    if w < width:
        low = np.minimum(low[:w - width], low[width - w:])
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    size = np.diff(np.append(first, len(low)))
    if size.max() > LONGEST:
        cut = -(-size // LONGEST)
        place = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
        first, size = np.repeat(first, cut) + place * LONGEST, np.minimum(np.repeat(size, cut) - place * LONGEST, LONGEST)
    return first, size, low[first]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (doc_id, text, hashes of its words), a few MB of text in each."""
    for batch in batches:
        for part in slices(batch, "text", 2 << 20):
            out = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                raw = (text or "").encode()
                out.append((doc_id, raw, word_hashes(raw)))
            yield out


def _minimisers(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _documents(batches):
            found = [(x[2], i) for i, _, h in docs if i is not None and len(x := super_kmers(h, window)) and len(x[2])]
            if found:
                low, doc = np.concatenate([x for x, _ in found]), np.repeat([i for _, i in found], [len(x) for x, _ in found])
                order = np.lexsort((doc, low))
                low, doc = low[order], doc[order]
                at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
                n = np.diff(np.append(at, len(low)))
                yield pa.RecordBatch.from_arrays([pa.array(low[at].view(np.int64)), pa.array(n), pa.array(doc[at]), pa.array(doc[at + n - 1])], ["low", "n", "least", "most"])
    return run


def _strings(raw, hashes, window, live, frequent) -> Iterator[tuple[int, int, bytes]]:
    """(first window, bucket, packed words) of what travels of a document."""
    first, size, low = super_kmers(hashes, window)
    go = live(low) if len(low) else np.empty(0, bool)
    first, size, low = first[go], size[go], low[go]
    words = raw.split() if len(low) else []
    often = frequent(low) if len(low) else np.empty(0, bool)
    for a, n, bucket, each in zip(first.tolist(), size.tolist(), low.view(np.int64).tolist(), often.tolist()):
        if each:
            own = rolling(hashes[a:a + n + window - 1], window).view(np.int64).tolist()
            yield from ((a + i, own[i], b" ".join(words[a + i:a + i + window])) for i in range(n))
        else:
            yield a, bucket, b" ".join(words[a:a + n + window - 1])


def _key(packed: bytes) -> tuple[int, int]:
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(packed), np.int64).tolist())


def _travel(window: int, live, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _documents(batches):
            # of equal strings one goes, with its smallest and largest document
            out: dict[bytes, list] = {}
            for doc_id, raw, hashes in docs:
                for _, bucket, packed in _strings(raw, hashes, window, live, frequent) if doc_id is not None else ():
                    own = out.setdefault(packed, [bucket, doc_id, doc_id])
                    own[1], own[2] = min(own[1], doc_id), max(own[2], doc_id)
            if out:
                bucket, least, most = zip(*out.values())
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(list(out), pa.binary()), pa.array(least, pa.int64()), pa.array(most, pa.int64())], ["bucket", "packed", "least", "most"])
    return run


def equal_windows(words: pa.Array, sizes: np.ndarray, least: np.ndarray, most: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings that lie in ``words`` one after the other, ``sizes`` words each: (string,
    window in it, smallest document) of each window that two documents or more have.

    Windows are sorted by a hash of their words' codes; neighbours are compared code by code."""
    code = np.asarray(pc.dictionary_encode(words).indices).astype(np.uint64)
    ends = np.cumsum(sizes)
    hashes = rolling((code + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(0x1234567), window)
    inside = np.ones(len(code) + 1, bool)
    for e in range(1, window):  # windows that would reach into the next string
        inside[ends - e] = False
    at = np.flatnonzero(inside[:len(hashes)])
    string = np.searchsorted(ends, at, side="right")
    order = np.argsort(hashes[at], kind="stable")
    at, string = at[order], string[order]
    new = np.concatenate([[True], hashes[at[1:]] != hashes[at[:-1]]])
    same = np.flatnonzero(~new)
    differ = np.zeros(len(same), bool)
    for j in range(window):
        differ |= code[at[same] + j] != code[at[same - 1] + j]
    if differ.any():  # two sequences have one hash: sort those of that hash by their words
        for h in np.unique(hashes[at[same[differ]]]):
            own = np.flatnonzero(hashes[at] == h)
            texts = [tuple(code[p:p + window]) for p in at[own]]
            turn = sorted(range(len(own)), key=texts.__getitem__)
            at[own], string[own] = at[own][turn], string[own][turn]
            new[own] = [k == 0 or texts[turn[k]] != texts[turn[k - 1]] for k in range(len(turn))]
    group = np.flatnonzero(new)
    low, high = np.minimum.reduceat(least[string], group), np.maximum.reduceat(most[string], group)
    sizes_of = np.diff(np.append(group, len(at)))
    shared = np.repeat(low < high, sizes_of)
    return string[shared], (at - (ends - sizes)[string])[shared], np.repeat(low, sizes_of)[shared]


def _count(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("packed", pa.binary()), ("least", pa.int64()), ("most", pa.int64())]))
        if not len(table):
            return
        packed = table.column("packed").combine_chunks()
        words = pc.split_pattern(packed.cast(pa.string()), " ")
        string, place, first = equal_windows(words.flatten(), np.diff(np.asarray(words.offsets)), np.asarray(table.column("least")), np.asarray(table.column("most")), window)
        if not len(string):
            return
        order = np.lexsort((place, string))
        string, place, first = string[order], place[order], first[order]
        begin = np.flatnonzero(np.concatenate([[True], (string[1:] != string[:-1]) | (place[1:] != place[:-1] + 1) | (first[1:] != first[:-1])]))
        n = np.diff(np.append(begin, len(string)))
        keys = {s: _key(packed[s].as_py()) for s in np.unique(string).tolist()}
        hi, lo = zip(*(keys[s] for s in string[begin].tolist()))
        rows = [pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(place[begin]), pa.array(n), pa.array(first[begin])]
        for a in range(0, len(begin), 50_000):
            yield pa.RecordBatch.from_arrays([r.slice(a, 50_000) for r in rows], ["hi", "lo", "place", "n", "first"])
    return run


def _places(window: int, live, frequent, known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for docs in _documents(batches):
            rows: list[tuple] = []
            for doc_id, raw, hashes in docs:
                if doc_id is not None and (found := [(a, *_key(p)) for a, _, p in _strings(raw, hashes, window, live, frequent)]):
                    starts, hi, lo = map(np.array, zip(*found))
                    text = int(np.uint64(xxhash.xxh3_64_intdigest(raw)).view(np.int64))
                    rows += [(doc_id, text, int(starts[i]), int(hi[i]), int(lo[i])) for i in np.flatnonzero(known(hi))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "text_hash", "start", "hi", "lo"])
    return run


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(touched):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                raws = [(t or "").encode() for t in part.column("text").to_pylist()]
                hashes = np.array([xxhash.xxh3_64_intdigest(r) for r in raws], np.uint64)
                cut = touched(hashes)
                words = [r.split() for r in raws]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(hashes.view(np.int64)), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([None if c else _digest(w) for w, c in zip(words, cut)], pa.string()), pa.array([r if c else None for r, c in zip(raws, cut)], pa.binary())],
                    ["doc_id", "text_hash", "n_words", "kept_sha256", "raw"])
    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "raw"):
                rows = []
                for doc_id, n, sha, raw, runs in zip(*(part.column(c).to_pylist() for c in ("doc_id", "n_words", "kept_sha256", "raw", "runs"))):
                    gone = np.zeros(n + 1, np.int64)
                    for r in runs or ():
                        gone[r["at"]] += 1
                        gone[r["at"] + r["n"] + window - 1] -= 1
                    out = np.cumsum(gone[:-1]) > 0
                    rows.append((doc_id, n, int(out.sum()), sha if raw is None else _digest([w for w, o in zip(raw.split(), out) if not o])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def repeated_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, runs): for each text with repeated passages the runs (at, n) of
    windows that start in a document with a smaller id too."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    lows = stored(docs.mapInArrow(_minimisers(window), "low long, n long, least long, most long")
                  .groupBy("low").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).where("least < most").select("low", "n"), "minimisers")
    total = lows.agg(F.sum("n")).first()[0] or 0
    live = BitFilter(spark, lows.select("low")).test()
    frequent = BitFilter(spark, lows.where(F.col("n") > LEAST_FREQUENT).select("low"), FREQUENT_BITS).test()
    strings = docs.mapInArrow(_travel(window, live, frequent), "bucket long, packed binary, least long, most long")
    found = stored(strings.repartition(parts_for(spark, total, STRINGS), "bucket").select("packed", "least", "most")
                   .mapInArrow(_count(window), "hi long, lo long, place long, n long, first long"), "equal-windows")
    # a row for each string: it has LONGEST windows at most, and is listed for each task it came from
    found = found.groupBy("hi", "lo").agg(F.collect_set(F.struct("place", "n", "first")).alias("found"))
    known = BitFilter(spark, found.select("hi")).test()
    places = docs.mapInArrow(_places(window, live, frequent, known), "doc_id long, text_hash long, start long, hi long, lo long")
    smaller = F.filter("found", lambda r: r["first"] < F.col("doc_id"))
    own = F.transform(smaller, lambda r: F.struct((F.col("start") + r["place"]).alias("at"), r["n"].alias("n")))
    runs = places.join(found, ["hi", "lo"]).select("doc_id", "text_hash", own.alias("own")).where(F.size("own") > 0)
    return runs.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("own")).alias("runs"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each of ``docs`` (doc_id, text).

    A null text has no words. A row without doc_id neither loses words nor takes them from
    others; rows that repeat a doc_id don't count as smaller than each other. Other columns are
    left aside. An empty table gives no rows.
    """
    runs = stored(repeated_runs(docs, window), "repeats")
    touched = BitFilter(docs.sparkSession, runs.select("text_hash")).test()
    whole = docs.select("doc_id", "text").mapInArrow(_whole(touched), "doc_id long, text_hash long, n_words long, kept_sha256 string, raw binary")
    return (whole.join(runs, ["doc_id", "text_hash"], "left").select("doc_id", "n_words", "kept_sha256", "raw", "runs")
            .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string"))
