"""Vector code compression: product codes whose nearest entries come from bit masks.

A vector is cut into parts, and each part is told by the nearest entry of the part's codebook.
Along each dimension of a part the entries lie sorted, and every place in that order carries
the mask of the entries before it. The distance to some entry near in sum is the initial
radius of a search: in each dimension the entries within it are one range, whose mask is
the prefix mask at its end less that at its start, and the masks of all dimensions ANDed hold
every entry that can be as near. Only those are measured, in integers, so ties are exact.

Every round reads all vectors. A task sums what falls to each entry, Spark adds the sums up,
and only the codebooks, whose size does not depend on the table, are on the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from .common import stored

#: Parts of a vector, entries of a codebook, rounds that move the entries, and the number of steps in a unit.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors that are searched at once.
_AT_ONCE = 1 << 13
#: Above this, floats have no fraction and are scaled as integers.
_WHOLE = 2.0 ** 50
_LONG = 2 ** 63 - 1


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite floats: int64, or Python's integers where that is too small."""
    x = np.asarray(x, np.float64)
    big = np.abs(x) >= _WHOLE
    if not big.any():
        return np.floor(x * SCALE).astype(np.int64)
    out = np.floor(np.where(big, 0, x) * SCALE).astype(np.int64).astype(object)
    out[big] = [int(v) * SCALE for v in x[big]]
    return out


def _exact(v: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are if the sum of all squared differences fits a long, else as Python's integers."""
    most = max(int(np.abs(a).max()) if a.size else 0 for a in (v, books))
    if v.dtype != object and books.dtype != object and (2 * most) ** 2 * max(v.shape[1], 1) < 2 ** 62:
        return v, books
    return v.astype(object), books.astype(object)


@dataclass
class Search:
    """The entries of one part, sorted along each dimension."""
    entries: np.ndarray  # entries x dimensions
    places: list[np.ndarray]  # sorted coordinates of each dimension
    prefix: list[np.ndarray]  # and the masks of the entries before each place: (entries + 1) x words
    sums: np.ndarray  # sorted sums of the entries
    by_sum: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Search:
        n, dims = entries.shape
        words = -(-n // 64)
        own = np.zeros((n, words), np.uint64)
        own[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        places, prefix = [], []
        for d in range(dims):
            order = np.argsort(entries[:, d], kind="stable")
            places.append(entries[order, d])
            prefix.append(np.concatenate([np.zeros((1, words), np.uint64), np.bitwise_or.accumulate(own[order])]))
        sums = entries.sum(axis=1) if dims else np.zeros(n, np.int64)
        by_sum = np.argsort(sums, kind="stable")
        return cls(entries, places, prefix, sums[by_sum], by_sum)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (rows x words) of the entries whose every coordinate is within ``radius``."""
        found = np.full((len(x), self.prefix[0].shape[1] if self.prefix else 1), np.uint64(0xFFFFFFFFFFFFFFFF))
        for d, (places, prefix) in enumerate(zip(self.places, self.prefix)):
            low = np.searchsorted(places, x[:, d] - radius, side="left")
            high = np.searchsorted(places, x[:, d] + radius, side="right")
            found &= prefix[high] ^ prefix[low]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest of the nearest entries of each row of ``x``, and the squared distance."""
        at = np.clip(np.searchsorted(self.sums, x.sum(axis=1)), 0, len(self.sums) - 1) if x.shape[1] else np.zeros(len(x), np.int64)
        label = self.by_sum[at]
        best = ((x - self.entries[label]) ** 2).sum(axis=1) if x.shape[1] else np.zeros(len(x), np.int64)
        radius = np.array([math.isqrt(v) + 1 for v in best], object) if best.dtype == object else np.sqrt(best).astype(np.int64) + 1
        found = self.candidates(x, radius)
        label, best = np.full(len(x), -1), best + 1
        for e in range(len(self.entries)):
            rows = np.flatnonzero(found[:, e // 64] >> np.uint64(e % 64) & np.uint64(1))
            if len(rows):
                far = ((x[rows] - self.entries[e]) ** 2).sum(axis=1) if x.shape[1] else np.zeros(len(rows), np.int64)
                nearer = np.asarray(far < best[rows], bool)
                best[rows[nearer]] = far[nearer]
                label[rows[nearer]] = e
        return label, best


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` integers; shorter vectors get zeros at the end."""
    length = np.asarray(pc.list_value_length(column))
    flat = scaled(column.flatten().to_numpy(zero_copy_only=False))
    if (length == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), flat.dtype)
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def _parts(batches: Iterator[pa.RecordBatch], books: np.ndarray):
    """Of each slice of rows its batch, vectors and, by part, labels and distances."""
    parts, _, width = books.shape
    last = None
    for whole in batches:
        for at in range(0, whole.num_rows, _AT_ONCE):
            batch = whole.slice(at, _AT_ONCE)
            v, known = _exact(_vectors(batch.column("vector"), parts * width), books)
            if last is None or last[0].dtype != known.dtype:
                last = (known, [Search.of(b) for b in known])
            yield batch, v, [s.nearest(v[:, p * width:(p + 1) * width]) for p, s in enumerate(last[1])]


def _sums(books: np.ndarray):
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), object)
        count = np.zeros((parts, entries), np.int64)
        for _, v, found in _parts(batches, books):
            for p, (label, _) in enumerate(found):
                x = v[:, p * width:(p + 1) * width]
                order = np.argsort(label, kind="stable")
                starts = np.flatnonzero(np.diff(label[order], prepend=-1))
                if len(order):
                    e = label[order][starts]
                    if width:
                        total[p, e] += np.add.reduceat(x[order], starts, axis=0).astype(object)
                    count[p] += np.bincount(label, minlength=entries)
        p, e = np.nonzero(count)
        rows = [(int(a), int(b), int(count[a, b]), k, str(total[a, b, k]) if width else "0") for a, b in zip(p, e) for k in range(max(width, 1))]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "entry", "n", "place", "total"), r)) for r in rows], schema=_SUMS)

    return sums


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("place", pa.int32()), ("total", pa.string())])


def _coded(books: np.ndarray):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{e:02x}" for e in range(max(256, books.shape[1]))], object)
        for batch, _, found in _parts(batches, books):
            code = np.full(batch.num_rows, "", object)
            error = np.zeros(batch.num_rows, object)
            for label, best in found:
                code = code + hexes[label]
                error = error + best
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array([min(int(x), _LONG) for x in error], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return coded


def kept_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, vector, label of the rows whose vector has finite components only."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(v.isNotNull() & ~F.coalesce(bad, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"), F.col(label).alias("label"))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x dimensions) of ``vectors`` (vec_id, vector), by ``rounds``
    rounds over all of them; None without vectors. They start from the smallest vec_ids (of a
    vec_id that comes twice, the smaller vector first); with fewer vectors they have fewer
    entries. The length of all is that of the longest vector, rounded up to whole parts."""
    dims = vectors.agg(F.max(F.size("vector"))).first()[0]
    if dims is None:
        return None
    width = -(-dims // parts)
    first = vectors.where("vec_id is not null").orderBy("vec_id", "vector").limit(entries).select("vector").toArrow()
    if not first.num_rows:
        return None
    books = _vectors(first.column(0).combine_chunks(), parts * width).reshape(first.num_rows, parts, width).transpose(1, 0, 2)
    for _ in range(rounds):
        sums = (vectors.select("vector").mapInArrow(_sums(books), "part int, entry int, n long, place int, total string")
                .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        moved = books.astype(object)
        for r in sums.collect():  # a row for each number in the codebooks
            if width:
                moved[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = moved if books.dtype == object or any(abs(x) >= 2 ** 62 for x in moved.flat) else moved.astype(np.int64)
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of each of ``vectors`` (vec_id, vector, label)."""
    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(_coded(books), f"vec_id long, label {kind}, code string, error long")


def written(books: np.ndarray) -> str:
    """All numbers of the codebooks by part, entry and place."""
    return ",".join(str(int(x)) for x in books.reshape(-1))


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the ``rows`` whose vector is kept.

    A row whose vector is null or has a null, NaN or infinite component is dropped. Vectors
    shorter than the longest get zeros at their end, as does the longest to be cut evenly; empty
    ones are all zeros. A row without vec_id is coded but starts no entry, and if no row has a
    vec_id there is nothing to start from and no row is returned. Rows that repeat a vec_id are
    coded each. Equal distances go to the lower index. Numbers of any size are exact; sums of
    distances that do not fit a long are told as the largest long. Null labels are one group.
    Other columns are left aside. An empty table gives no rows.
    """
    vectors = kept_vectors(rows, vec_id, vector, label)
    books = fit(vectors)
    if books is None:
        return rows.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    codes = stored(encode(vectors, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    of = codes.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of_label")
    digest = hashlib.sha256(written(books).encode()).hexdigest()
    return join_small(codes, of, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
