"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over hashed words, reduced by a randomised SVD whose products with
the passage matrix are computed by Spark tasks. Document frequencies come from all
documents; the SVD is fitted on all their passages and the benchmark's own. Every passage of every document is then indexed: windows as wide as an item, a
quarter of their width apart, whose cosine with the item makes candidates. A candidate
is a leak if the longest common subsequence of words covers most of the item, or a good
part of it together with its answer, the item's last sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import handing_back, parts_for, placed_hashes, rolling, slices, stored, word_hashes

BITS, RANK, OVER, PASSES = 15, 64, 16, 2
SIZE = 1 << BITS
#: Words of a passage that the SVD is fitted on; passages that are multiplied at once, and passages of a
#: stored row (5 KB: readers hold 4096 rows).
PASSAGE, ROWS, STORED = 40, 12288, 64
#: Rows that are added up at once; rows of the tasks' sums that travel together; passages of a task.
GROUP, PART, PART_INNER, EACH = 16, 1024, 8, 1_000_000
#: Widths of windows; an item takes the nearest, a longer one is cut into pieces of the last.
WIDTHS = (8, 11, 16, 24, 36, 54)
COSINE = 0.5
#: Shares of an item's words in common order that make a leak: alone, or with this share of its answer.
ALONE, WITH_ANSWER, ANSWER = 0.75, 0.55, 0.8
#: Items with fewer words must be there word by word.
SHORT = 6
#: Items compared in one pass; words that are summed at once.
ITEMS, BLOCK = 5000, 4096
#: Bytes of text, and candidates, that are looked at together.
BATCH, CANDIDATES = 1 << 18, 1 << 13
LEAKS = "doc_id long, item_id long, cosine double, common double, answer double"

_MARKS = bytes(c for c in range(128) if not chr(c).isalnum() and not 9 <= c <= 13 and c != 32)


def terms(text: str | None) -> np.ndarray:
    """A hash of each word, lower-cased and without marks; words of marks alone are left out."""
    return word_hashes((text or "").lower().encode().translate(None, _MARKS))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Queries:
    """Items as word lists, and for each width the item and vector of its pieces."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    projection: np.ndarray
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        self.masks = [bit_masks(h) for h in self.words]
        self.answer_words, self.answers = [len(a) for a in self.answers], [bit_masks(a) for a in self.answers]
        self.sizes = np.array([len(h) for h in self.words])
        self.slack = np.maximum(4, self.sizes // 4)
        self.least = np.ceil(WITH_ANSWER * self.sizes).astype(np.int64)
        found: dict[int, list] = {}
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by words: sorted hashes of the sequences, items
        for n in range(1, SHORT):
            items = np.flatnonzero(self.sizes == n)
            if len(items):
                keys = np.array([rolling(self.words[i], n)[0] for i in items], np.uint64)
                order = np.argsort(keys, kind="stable")
                self.short[n] = keys[order], items[order]
        for i, h in enumerate(self.words):
            if len(h) < SHORT:
                continue
            width = min(WIDTHS, key=lambda w: abs(np.log(w / max(1, len(h)))))
            if len(h) <= WIDTHS[-1] * 1.25:
                found.setdefault(width, []).append((i, 0, h))
            else:
                found.setdefault(width, []).extend((i, a, h[a:a + width]) for a in range(0, len(h) - width // 2, width // 2))
        for width, pieces in found.items():
            vectors = np.stack([self.projection[_bucket(h)].sum(axis=0) for *_, h in pieces])
            self.pieces[width] = (np.array([i for i, *_ in pieces]), np.array([a for _, a, _ in pieces]), _unit(vectors).T.copy())
        # which words an item may have, by a hash of both: some others pass, none of its own is missed
        item = np.repeat(np.arange(len(self.words)), self.sizes)
        self.bits = max(10, int(64 * len(item)).bit_length())
        self.has = np.zeros(1 << self.bits, bool)
        if len(item):
            self.has[self._place(np.concatenate(self.words), item)] = True

    def _place(self, words: np.ndarray, items: np.ndarray) -> np.ndarray:
        return ((words ^ items.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def may_have(self, words: np.ndarray, items: np.ndarray) -> np.ndarray:
        return self.has[self._place(words, items)]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def bit_masks(a: np.ndarray) -> dict[int, int]:
    """For each element of ``a`` a bit at each of its places."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def common_subsequence(masks: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of ``n`` elements, given by their masks, and ``b``."""
    full = row = (1 << n) - 1
    for y in b:
        if m := masks.get(y):
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts, and where each text's begin and end."""
    raws = [(t or "").lower().encode().translate(None, _MARKS) for t in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raws)])
    hashes, starts = placed_hashes(b"\n".join(raws))
    return hashes, np.searchsorted(starts, begins)


def _windows(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of windows a quarter of their width apart, the last at the text's end."""
    step, last = width // 4, np.maximum(sizes - width, 0)
    count = np.where(sizes > 0, -(-last // step) + 1, 0)
    text = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return text, np.minimum(place * step, last[text])


def _cumulated(rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The sums of the first 0, 1, 2, ... of ``rows[index]``, added up in all groups of ``GROUP`` at once."""
    n, width = len(index), rows.shape[1]
    out = np.zeros((1 + -(-n // GROUP) * GROUP, width), np.float32)
    np.take(rows, index, axis=0, out=out[1:n + 1], mode="clip")
    groups = out[1:].reshape(-1, GROUP, width)
    for k in range(1, GROUP):
        groups[:, k] += groups[:, k - 1]
    if len(groups) > 1:
        last = groups[:, -1].copy()
        groups += (_cumulated(last, np.arange(len(last)))[:-1] if len(last) > GROUP else np.cumsum(last, axis=0) - last)[:, None]
    return out[:n + 1]


def _candidates(h: np.ndarray, borders: np.ndarray, queries: Queries) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, item, where the item would begin in the text, cosine) of windows near an item."""
    windows = {w: _windows(np.diff(borders), w) for w in queries.pieces}
    firsts = {w: borders[t] + s for w, (t, s) in windows.items()}
    for begin in range(0, len(h), BLOCK):
        part = h[begin:begin + BLOCK + WIDTHS[-1]]
        sums = _cumulated(queries.projection, _bucket(part))
        for width, (items, offsets, vectors) in queries.pieces.items():
            a, b = np.searchsorted(firsts[width], [begin, begin + BLOCK])
            if a == b:
                continue
            text, start, first = windows[width][0][a:b], windows[width][1][a:b], firsts[width][a:b] - begin
            end = np.minimum(first + width, borders[text + 1] - begin)
            sum_of = sums[end] - sums[first]
            length = np.maximum(np.sqrt(np.einsum("ij,ij->i", sum_of, sum_of)), 1e-9)
            products = sum_of @ vectors
            s, q = np.divmod(np.flatnonzero(products >= COSINE * length[:, None]), len(items))
            if len(s):
                yield text[s], items[q], start[s] - offsets[q], products[s, q] / length[s]


def _plausible(h, borders, text, item, at, queries: Queries) -> np.ndarray:
    """Whether enough words around a candidate may be the item's."""
    n, slack, size = queries.sizes[item], queries.slack[item], np.diff(borders)[text]
    low, high = np.minimum(np.maximum(at - slack, 0), size), np.minimum(np.maximum(at + n + slack, 0), size)
    width = high - low
    of = np.repeat(np.arange(len(at)), width)
    place = np.arange(len(of)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(borders[text] + low, width)
    own = queries.may_have(h[place], item[of])
    return np.bincount(of[own], minlength=len(at)) >= queries.least[item]


def leaks_of(texts: list[str | None], queries: Queries) -> list[tuple[int, int, float, float, float]]:
    """(text, item_id, cosine, common share, answer share) of the items that each of the texts leaks."""
    h, borders = words_of(texts)
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for n, (keys, items) in queries.short.items():
        r = rolling(h, n)
        at = np.minimum(np.searchsorted(keys, r), len(keys) - 1)
        for p in np.flatnonzero(keys[at] == r).tolist():
            k, text = int(at[p]), int(np.searchsorted(borders, p, side="right")) - 1
            while k < len(keys) and keys[k] == r[p]:
                if p + n <= borders[text + 1] and np.array_equal(h[p:p + n], queries.words[items[k]]):
                    found[text, int(items[k])] = (1.0, 1.0, 1.0)
                k += 1
    near = list(_candidates(h, borders, queries))
    if near:
        text, item, at, cosine = map(np.concatenate, zip(*near))
        order = np.lexsort((-cosine, at, item, text))  # of equal places the largest cosine stays
        text, item, at, cosine = text[order], item[order], at[order], cosine[order]
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1])])
        text, item, at, cosine = text[new], item[new], at[new], cosine[new]
        for a in range(0, len(at), CANDIDATES):
            b = a + CANDIDATES
            some = a + np.flatnonzero(_plausible(h, borders, text[a:b], item[a:b], at[a:b], queries))
            for t, i, p, c in zip(text[some].tolist(), item[some].tolist(), at[some].tolist(), cosine[some].tolist()):
                n, masks, slack = int(queries.sizes[i]), queries.masks[i], int(queries.slack[i])
                begin, end = int(borders[t]), int(borders[t + 1])
                region = [x for x in h[max(begin, begin + p - slack):max(begin, min(end, begin + p + n + slack))].tolist() if x in masks]
                if len(region) < queries.least[i]:
                    continue
                share = common_subsequence(masks, n, region) / n
                if share < WITH_ANSWER or share <= found.get((t, i), (0, 0, 0))[1]:
                    continue
                told = common_subsequence(queries.answers[i], m := queries.answer_words[i], region) / m
                if share >= ALONE or told >= ANSWER:
                    found[t, i] = (c, share, told)
    return [(t, queries.ids[i], *x) for (t, i), x in sorted(found.items())]


def _cut(h: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The passages of texts, a row of sorted buckets each; the last of a text is filled up with ``SIZE``."""
    sizes = np.diff(borders)
    count = -(-sizes // PASSAGE)
    text = np.repeat(np.arange(len(sizes)), sizes)
    out = np.full(int(count.sum()) * PASSAGE, SIZE, "<u2")
    out[((np.cumsum(count) - count) * PASSAGE - borders[:-1])[text] + np.arange(len(h))] = _bucket(h)
    return np.sort(out.reshape(-1, PASSAGE), axis=1)


def _written(passages: np.ndarray) -> list[bytes]:
    return [passages[a:a + STORED].tobytes() for a in range(0, len(passages), STORED)]


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "text", BATCH)):
        rows = _written(_cut(*words_of(batch.column("text").to_pylist())))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["passages"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The passages of a task, ``ROWS`` or somewhat more of them together."""
    held, size = [], 0
    for batch in batches:
        for row in batch.column("passages").to_pylist():
            held.append(row)
            size += len(row)
            if size >= 2 * PASSAGE * ROWS:
                yield np.frombuffer(b"".join(held), "<u2").reshape(-1, PASSAGE)
                held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(held), "<u2").reshape(-1, PASSAGE)


def _runs(passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, bucket, how often the passage has it)."""
    new = np.ones(passages.shape, bool)
    new[:, 1:] = passages[:, 1:] != passages[:, :-1]
    begin = np.flatnonzero(new)
    return begin // PASSAGE, passages.ravel()[begin], np.diff(np.append(begin, passages.size))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(SIZE + 1, np.int64)  # the last counts passages
    for passages in _blocks(batches):
        df += np.bincount(_runs(passages)[1], minlength=SIZE + 1)
        df[-1] += len(passages) - (passages[:, -1] == SIZE).sum()
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["bucket", "n"])


def _added(rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each row of ``index`` the sum of the ``rows`` that it names."""
    out, ones = np.empty((len(index), rows.shape[1]), np.float32), np.ones(index.shape[1], np.float32)
    step = max(1, 2560 // index.shape[1])
    for a in range(0, len(index), step):
        out[a:a + step] = ones @ rows[index[a:a + step]]
    return out


def _sums(keys: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, the sum of its ``rows[at]``) of ascending ``keys``; ``GROUP`` of them at a time are added up."""
    while True:
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n = np.diff(np.append(begin, len(keys)))
        groups = -(-n // GROUP)
        index = np.full(int(groups.sum()) * GROUP, len(rows), np.int32)  # a row of zeros
        place = np.repeat(((np.cumsum(groups) - groups) * GROUP - begin).astype(np.int32), n)
        place += np.arange(len(keys), dtype=np.int32)
        index[place] = at
        del place
        rows = _added(np.concatenate([rows, np.zeros((1, rows.shape[1]), np.float32)]), index.reshape(-1, GROUP))
        keys = np.repeat(keys[begin], groups)
        if len(keys) == len(begin):
            return keys, rows
        at = np.arange(len(keys))


def _projected(weighted: np.ndarray, weights: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A q, the squares of the lengths by which both its rows and A's are yet to be divided)."""
    passage, bucket, n = _runs(passages)
    square = np.bincount(passage, (n * weights[bucket]) ** 2, minlength=len(passages))
    return _added(weighted, passages), np.maximum(square, 1e-9).astype(np.float32)[:, None]


def _weighted(q: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    weights = np.append(idf, 0).astype(np.float32)
    return np.concatenate([q * weights[:-1, None], np.zeros((1, q.shape[1]), np.float32)]), weights


def _product(q: np.ndarray, idf: np.ndarray):
    """This task's part of A' (A q), A being the matrix of passages; only rows that its passages have."""
    weighted, weights = _weighted(q, idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((SIZE, weighted.shape[1]), np.float32)
        for passages in _blocks(batches):
            y, square = _projected(weighted, weights, passages)
            y /= square
            order = np.argsort(passages.ravel(), kind="stable")
            keys = passages.ravel()[order]
            words = np.searchsorted(keys, SIZE)
            if words:
                order = (order[:words] // PASSAGE).astype(np.int32)
                keys, sums = _sums(keys[:words], order, y)
                out[keys] += sums
        out *= weights[:-1, None]
        yield from _sent(out, PART)
    return run


def _inner(q: np.ndarray, idf: np.ndarray):
    """This task's part of (A q)' (A q)."""
    weighted, weights = _weighted(q, idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((weighted.shape[1], weighted.shape[1]), np.float32)
        for passages in _blocks(batches):
            y, square = _projected(weighted, weights, passages)
            y /= np.sqrt(square)
            out += y.T @ y
        yield from _sent(out, PART_INNER)
    return run


def _sent(out: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``out`` that are not all zeros, ``part`` of its rows at a time."""
    for a in range(0, len(out), part):
        some = np.flatnonzero(out[a:a + part].any(axis=1))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([some.astype("<u2").tobytes()], pa.binary()), pa.array([out[a + some].tobytes()], pa.binary())], ["at", "rows", "part"])


def _total(matrix: DataFrame, task, part: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum of what each ``task`` over the matrix of passages sends; added up in tasks, by ``at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, rows, x in zip(*(batch.column(c).to_pylist() for c in ("at", "rows", "part"))):
                sums.setdefault(at, np.zeros((part, shape[1])))[np.frombuffer(rows, "<u2")] += np.frombuffer(x, np.float32).reshape(-1, shape[1])
        for at, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([x.astype(np.float32).tobytes()], pa.binary())], ["at", "part"])

    out = np.zeros((-(-shape[0] // part) * part, shape[1]), np.float32)
    parts = matrix.mapInArrow(handing_back(task), "at long, rows binary, part binary").repartition("at")
    for at, x in parts.mapInArrow(handing_back(run), "at long, part binary").toLocalIterator():
        out[at:at + part] = np.frombuffer(x, np.float32).reshape(part, -1)
    return out[:shape[0]]


def _basis(z: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``z``; directions that are rounding errors alone are left
    out. By the columns' products, so that nothing as large as ``z`` is held in double precision."""
    for _ in range(2):  # the second time mends what rounding left
        inner = sum(b.T @ b for b in (z[a:a + 4096].astype(np.float64) for a in range(0, len(z), 4096)))
        values, axes = np.linalg.eigh(inner)
        some = values > values.max() * 1e-10
        z = z @ (axes[:, some] / np.sqrt(values[some])).astype(np.float32)
    return z


def fit_projection(docs: DataFrame, items: list[np.ndarray], seed: int = 5) -> np.ndarray:
    """A vector for each bucket, so that a passage's vector is the sum of its words': idf times
    the right singular vectors, each scaled by its singular value's inverse. Fitted on the passages
    of all ``docs`` and of all ``items``."""
    spark = docs.sparkSession
    matrix = stored(docs.select("text").mapInArrow(handing_back(_passages), "passages binary"), "passages")
    counted = matrix.mapInArrow(handing_back(_frequencies), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    df = np.zeros(SIZE + 1)
    for bucket, n in counted:
        df[bucket] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    # as a table of Arrow, which needs no Python workers
    own = _cut(np.concatenate(items), np.cumsum([0, *map(len, items)]))
    matrix = matrix.unionByName(spark.createDataFrame(pa.table({"passages": pa.array(_written(own), pa.binary())})))
    # each task passes on a sum as large as q, however few passages it has
    matrix = matrix.coalesce(parts_for(spark, int(df[-1]) + len(own), EACH))
    rng = np.random.default_rng(seed)
    q = _basis(rng.standard_normal((SIZE, RANK + OVER), np.float32))
    for _ in range(PASSES):
        q = _basis(_total(matrix, _product(q, idf), PART, q.shape))
    inner = _total(matrix, _inner(q, idf), PART_INNER, (q.shape[1], q.shape[1]))  # of A'A in the basis q: its axes are the right singular vectors
    values, axes = np.linalg.eigh((inner + inner.T) / 2)
    some = np.flatnonzero(values > values.max() * 1e-6)[::-1][:RANK]  # the inverse of others would blow up rounding errors
    return idf.astype(np.float32)[:, None] * (q @ (axes[:, some] / np.sqrt(values[some])).astype(np.float32))


def _answer(text: str) -> np.ndarray:
    """Words of the last sentence, or of the last quarter if there is but one."""
    whole = terms(text)
    last = terms(re.split(r"[.!?\n]+\s*", text.strip().rstrip(".!?\n "))[-1])
    return last if 0 < len(last) < len(whole) else whole[-max(1, len(whole) // 4):]


def prepare(docs: DataFrame, benchmark: DataFrame) -> list[Queries]:
    """The items (item_id, text) in blocks of ``ITEMS``; those without words are left out."""
    items = [(i, t) for i, t in benchmark.select("item_id", "text").toLocalIterator() if len(terms(t))]
    if not items:
        return []
    words = [terms(t) for _, t in items]
    projection = fit_projection(docs, words)
    return [Queries([i for i, _ in items[a:a + ITEMS]], words[a:a + ITEMS], [_answer(t) for _, t in items[a:a + ITEMS]], projection) for a in range(0, len(items), ITEMS)]


def find_leaks(docs: DataFrame, blocks: list[Queries]) -> DataFrame:
    """A row of LEAKS for each of ``docs`` (doc_id, text) and item that it leaks.

    Null and empty texts leak nothing; repeated rows are searched each for itself, so are
    repeated items; other columns are left aside; without documents or items there are no rows."""
    def search(queries: Queries):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for whole in batches for part in slices(whole, "text", BATCH)):
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[t], *told) for t, *told in leaks_of(batch.column("text").to_pylist(), queries)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))], ["doc_id", "item_id", "cosine", "common", "answer"])
        return run

    out = docs.sparkSession.createDataFrame([], LEAKS)
    for k, queries in enumerate(blocks):
        found = docs.select("doc_id", "text").mapInArrow(handing_back(search(queries)), LEAKS)
        out = found if k == 0 else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, blocks: list[Queries]) -> DataFrame:
    """The rows of ``docs``, all columns, that leak nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH)):
            texts, clean = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
            for queries in blocks:
                clean[[t for t, *_ in leaks_of(texts, queries)]] = False
            yield batch.filter(pa.array(clean))
    return docs.mapInArrow(handing_back(run), docs.schema)
