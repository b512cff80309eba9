"""SimHash near duplicates: fingerprints of word shingles, compared as bit planes.

Two fingerprints of 64 bits that differ in at most two agree in two of any four blocks, so all
pairs to compare share 32 bits with one of six masks. A group that shares them and is larger
than ``MOST`` is dealt out again by three blocks of its other bits, one of which agrees, until
no group is; a group with few bits left cannot be large, as its fingerprints are distinct. So
no pair is lost and no task's work grows with the square of the corpus.

Within a task the fingerprints of a group lie as bit planes: word w of plane b holds bit b of
64 of them. A fingerprint is compared with 64 at once by XOR with a plane or its complement,
three planes are added at a time by carry-save adders into two counting planes, and blocks
whose 64 distances all exceed the radius are left out of what follows. Of the links that a
task finds only a forest goes on, so a group of near copies gives no more links than members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from .common import parts_for, slices, stored
from .components import components

WIDTH, RADIUS = 3, 2
#: Bits of a fingerprint, the blocks they are dealt to first, and the seed of the hash (fixed values).
BITS, BLOCKS, SEED = 64, 4, 42
#: Largest group that is compared as it is, and free bits that allow no larger one.
MOST, FEW = 1024, 10
#: Rows of a task that are held at once, and blocks compared at once.
_HELD, _AT_ONCE = 1 << 15, 1 << 14
#: Shingles hashed at once.
_SHINGLES = 1 << 16
#: Rows of all groups to a task.
_EACH = 1 << 18
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: The bits of each byte.
_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACE = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(raw: bytes, width: int = WIDTH) -> int:
    """The SimHash of a text in UTF-8; a bit is set if it is in over half the hashes."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    del words
    n = max(len(end) - width + 1, 1)
    end = end[min(width, len(end)) - 1:]
    counts = np.zeros(BITS, np.int64)
    for a in range(0, n, _SHINGLES):
        b = min(n, a + _SHINGLES)
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(start[a:b].tolist(), end[a:b].tolist())), np.uint64, b - a)
        columns = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[8 * k:8 * k + 8] += np.bincount(columns[:, k], minlength=256) @ _BYTE
    return int(_PLACE[2 * counts > n].sum())


def _prints(width: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [fingerprint(raw or b"", width) for raw in batch.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return prints


def masks(bits: list[int], blocks: int, same: int) -> list[int]:
    """The bits of each choice of ``same`` of ``blocks`` blocks of ``bits``, as signed longs."""
    edges = [len(bits) * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[x:y]) for x, y in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(parts, same)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def free_bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if not mask >> b & 1]


def planes_of(fps: np.ndarray) -> np.ndarray:
    """uint64[64, words]: bit k of word w of plane b is bit b of fps[64 w + k]."""
    padded = np.zeros(-(-len(fps) // BITS) * BITS, np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8").astype(np.uint64)


def _exceeds(ones: np.ndarray, twos: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Where a count (over: four or more; else ones + 2 twos) is above the radius."""
    return over | (ones | twos, twos, ones & twos, np.uint64(0))[radius]


def within(fps: np.ndarray, row: np.ndarray, word: np.ndarray, valid: np.ndarray, planes: np.ndarray, bits: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) at most ``radius`` apart in ``bits``, of each block's row i and those of the
    64 rows of its word that are set in ``valid``."""
    ones, twos, over = (np.zeros(len(row), np.uint64) for _ in range(3))
    own = fps[row]

    def differ(b: int) -> np.ndarray:
        return planes[b][word] ^ (np.uint64(0) - ((own >> np.uint64(b)) & np.uint64(1)))

    for k in range(0, len(bits), 3):
        x, y, z = (differ(b) for b in bits[k:k + 3]) if k + 3 <= len(bits) else (*(differ(b) for b in bits[k:]), *[np.zeros(len(row), np.uint64)] * (k + 3 - len(bits)))
        half = x ^ y
        low, carry = half ^ z, (x & y) | (half & z)
        more = ones & low
        ones ^= low
        half = twos ^ carry
        over |= (twos & carry) | (half & more)
        twos = half ^ more
        valid = valid & ~_exceeds(ones, twos, over, radius)
        left = np.flatnonzero(valid)
        if 4 * len(left) < 3 * len(valid):
            row, word, own, ones, twos, over, valid = (v[left] for v in (row, word, own, ones, twos, over, valid))
    left = np.flatnonzero(valid)
    at, bit = np.nonzero(np.unpackbits(valid[left].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return row[left][at], word[left][at] * BITS + bit


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins a[k] and b[k]; ``root`` holds the smallest index of each one's set."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def forest(group: np.ndarray, fps: np.ndarray, bits: list[int], radius: int) -> np.ndarray:
    """The smallest row that each row reaches by links within its group (ascending numbers)."""
    n = len(fps)
    root = np.arange(n)
    edge = np.append(np.flatnonzero(np.diff(group)) + 1, n)
    end = np.repeat(edge, np.diff(np.concatenate([[0], edge])))
    rows = np.flatnonzero(end > np.arange(n) + 1)
    if not len(rows):
        return root
    planes = planes_of(fps)
    first = (rows + 1) // BITS
    blocks = (end[rows] - 1) // BITS - first + 1
    before = np.cumsum(blocks)
    for a in range(0, int(before[-1]), _AT_ONCE):
        at = np.arange(a, min(a + _AT_ONCE, int(before[-1])))
        which = np.searchsorted(before, at, side="right")
        row, word = rows[which], first[which] + at - (before - blocks)[which]
        low = np.maximum(row + 1 - word * BITS, 0).astype(np.uint64)
        high = np.minimum(end[row] - word * BITS, BITS).astype(np.uint64)
        valid = (_ALL << low) & (_ALL >> (np.uint64(BITS) - high))
        joined(root, *within(fps, row, word, valid, planes, bits, radius))
    return root


def _linked(radius: int):
    """Links within groups of rows (mask, key, fp, doc) that come sorted by group."""
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def done(mask, key, fp, doc):
            for m in np.unique(mask):  # 6 of them, or a few more where groups were dealt again
                mine = mask == m
                change = np.cumsum(np.concatenate([[0], np.diff(key[mine]) != 0]))
                root = forest(change, fp[mine].view(np.uint64), free_bits(int(m)), radius)
                far = np.flatnonzero(root != np.arange(len(root)))
                if len(far):
                    yield pa.RecordBatch.from_arrays([pa.array(doc[mine][far]), pa.array(doc[mine][root[far]])], names=["a", "b"])

        for batch in batches:
            held.append(tuple(np.asarray(batch.column(c)) for c in ("mask", "key", "fp", "doc")))
            rows += batch.num_rows
            if rows >= _HELD:
                cols = [np.concatenate(c) for c in zip(*held)]
                cut = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0))
                cut = int(cut[-1]) + 1 if len(cut) else 0
                if cut:
                    yield from done(*(c[:cut] for c in cols))
                held, rows = [tuple(c[cut:] for c in cols)], rows - cut
        if rows:
            yield from done(*(np.concatenate(c) for c in zip(*held)))

    return linked


def _keyed(rows: DataFrame, choices) -> DataFrame:
    keyed = rows.withColumn("mask", F.explode(choices))
    return keyed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "doc")


def near_links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between documents of ``classes`` (fp long, each once; doc long) that connect
    all whose fingerprints differ in at most ``radius`` bits (0 to 3), with each other alone or
    through documents between."""
    if not 0 <= radius <= 3:
        raise ValueError(f"radius is {radius}, not between 0 and 3")
    spark = classes.sparkSession
    known = masks(list(range(BITS)), max(BLOCKS, radius + 2), max(BLOCKS, radius + 2) - radius)
    keyed = _keyed(classes, F.array(*[F.lit(m) for m in known]))
    links = None
    while True:
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        hot = stored(sizes.where((F.col("n") > MOST) & (F.bit_count("mask") < BITS - FEW)).select("mask", "key"), "simhash-hot")
        parts = parts_for(spark, keyed.count(), _EACH)
        cold = join_small(keyed, hot, ["mask", "key"], "left_anti")
        found = cold.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_linked(radius), "a long, b long")
        found = stored(found, "simhash-links")
        links = found if links is None else links.unionByName(found)
        again = [r[0] for r in hot.select("mask").distinct().collect()]  # masks: 6 at first, at most three times as many each turn
        if not again:
            return links
        # ends: each turn fixes a third of a group's free bits
        finer = {m: [_signed((m | s) & int(_ALL)) for s in masks(free_bits(m), radius + 1, 1)] for m in again}
        choices = F.create_map(*[x for m, s in finer.items() for x in (F.lit(m), F.array(*map(F.lit, s)))])
        keyed = stored(_keyed(join_small(keyed, hot, ["mask", "key"], "left_semi").withColumnRenamed("mask", "coarse"), choices[F.col("coarse")]), "simhash-again")


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id of each of ``docs`` (doc_id, text): two documents link
    when their fingerprints differ in at most ``radius`` bits; the component is the smallest
    doc_id reachable by links.

    A text that is null or has no word has fingerprint zero and is linked like any other. A row
    without doc_id is linked with nothing and has no component. Rows that repeat a doc_id are
    one document with several fingerprints. Other columns are left aside. An empty table gives
    no rows.
    """
    prints = stored(docs.select("doc_id", "text").mapInArrow(_prints(width), "doc_id long, fp long"), "fingerprints")
    classes = stored(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc")), "simhash-classes")
    several = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x < y").select("doc_id")
    several = prints.join(several, "doc_id").select("doc_id", "fp").distinct().join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    label = components(near_links(classes, radius).unionByName(several))
    of = classes.join(label, classes.doc == label.node, "left").select("fp", F.coalesce("component", "doc").alias("component_id"))
    return prints.join(of, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
