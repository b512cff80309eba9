"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: What separates words everywhere in this subpackage (fixed value): blank, \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage and
    survives the loss of an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete now what it shuffled for tables that nothing refers to any more; by itself it
    does so when the driver's heap fills up, which may be long after the disk does."""
    gc.collect()
    spark._jvm.System.gc()


def handing_back(run):
    """``run`` of a mapInArrow, after which its worker gives what it freed back to the system: workers
    live on for later stages, which have other tasks' memory beside theirs."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)
    return whole


#: Bytes of rows that go to a Python worker at once. Spark's own limit lets a whole partition's texts
#: through as one batch, held by the worker and, as sent and as received, by its executor.
WORKER_BYTES = 4 << 20


def small_batches(spark: SparkSession, most: int = WORKER_BYTES) -> None:
    """Lets the session send at most about ``most`` bytes to a Python worker at once; a lower limit stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(name))
    if not now or int(now[1]) > most:
        spark.conf.set(name, str(most))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds about ``most`` bytes of ``column`` (one row at least)."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    part = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


#: Bits of a BitFilter as a power of two; 27 makes 16 MB, whatever the input.
FILTER_BITS = 27


class BitFilter:
    """A bitmap of hashed keys of fixed size, broadcast to the tasks. It may let other keys
    pass, so it only spares work: what passes is compared exactly afterwards."""

    def __init__(self, spark: SparkSession, keys: DataFrame, bits: int = FILTER_BITS):
        """``keys``: one column of longs, already well mixed; nulls are left out."""
        key = F.col(keys.columns[0])
        place = F.shiftrightunsigned(key, 64 - bits) + 1  # buckets of 32768 places, counted from 1
        maps = (keys.where(key.isNotNull())
                .groupBy(F.bitmap_bucket_number(place).alias("b"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m")))
        whole = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for b, m in maps.toLocalIterator():  # at most 2**bits / 32768 rows of 4 KB
            m = np.frombuffer(m, dtype=np.uint8)
            whole[(b - 1) * 4096:(b - 1) * 4096 + len(m)] |= m
        self.bits = bits
        self.shared = spark.sparkContext.broadcast(whole)

    def test(self) -> BitTest:
        return BitTest(self.bits, self.shared)

    def drop(self) -> None:
        """Takes the bitmap from the driver and all executors. Only when what it helped to make is stored."""
        self.shared.destroy()


class BitTest:
    """The part of a BitFilter that goes to the tasks."""

    def __init__(self, bits: int, shared):
        self.bits, self.shared = bits, shared

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """keys: int64 or uint64; True where the key may have been added."""
        place = keys.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.shared.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def parts_for(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions for ``rows`` rows of about ``each`` to a task, and a wave of tasks at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each), 1)


#: A multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    power, inverse = _grown(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n])])
    return mixed((sums[width:] - sums[:-width]) * inverse[:n - width + 1])


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
#: Bytes that are hashed at once.
_BLOCK = 1 << 18
_NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")


#: The lowest 0 to 8 bytes of a 64-bit value, and bytes of a word that are taken 8 at a time.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 128


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word of a text in UTF-8, in order, without a step per word."""
    return placed_hashes(raw)[0]


def placed_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a text's words, and where each word begins."""
    found, at = [], 0
    while len(raw) - at > _BLOCK:
        cut = _NEXT_BLANK.search(raw, at + _BLOCK)
        end = cut.start() if cut else len(raw)
        found.append((*_block_hashes(raw[at:end]), at))
        at = end
    found.append((*_block_hashes(raw[at:]), at))
    if len(found) == 1:
        return found[0][:2]
    return np.concatenate([h for h, *_ in found]), np.concatenate([start + a for _, start, a in found])


def _block_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = b"\n" + raw + b"\n" * 8
    codes = np.frombuffer(held, np.uint8)
    blank = _BLANK[codes]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, n = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray((len(held) - 7,), "<u8", held, strides=(1,))  # at each place its 8 bytes
    h = mixed((eight[start] & _LOWEST[np.minimum(n, 8)]) + n.astype(np.uint64) * np.uint64(_BASE))
    more = np.flatnonzero(n > 8)
    for k in range(8, _LONG, 8):
        if not len(more):
            return h, start - 1
        h[more] = mixed(h[more] * np.uint64(0xA24BAED4963EE407) + (eight[start[more] + k] & _LOWEST[np.minimum(n[more] - k, 8)]))
        more = more[n[more] > k + 8]
    for i in more.tolist():  # what is left of a long word, all bytes at once
        rest = codes[start[i] + _LONG:start[i] + n[i]]
        power = _grown(len(rest))[0]
        h[i] = mixed(h[i:i + 1] * np.uint64(0xA24BAED4963EE407) + (_VALUES[rest] * power[:len(rest)]).sum(dtype=np.uint64))[0]
    return h, start - 1
