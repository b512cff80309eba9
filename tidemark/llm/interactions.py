"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

A document is a set of the filters that it fails, so all orders of n filters need only the
counts of the 2**n sets. The step at which an order removes a set is a product of matrices in
which numbers are added and the least sum is taken (min-plus): one holds 0 where a set has a
filter and n where it lacks it, the other the place of each filter in each order, the inverse
of the permutation. The steps then scatter the weighted counts of the sets over orders and
steps. Spark counts the sets of each part of the corpus; the matrices are the same for all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

#: Most filters whose orders are all told: 5040 orders, 35280 rows a part.
MOST_FILTERS = 7
#: Limits of the five filters (fixed values).
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
NAMES = "ABCDE"
_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(rb"[#$%&*|]")
#: Bits of A, B, C, D; E has the next one.
REPEATED = 1 << 4
JUDGED = "doc_id long, part string, fails int, digest binary"
#: Rows of the report that a task makes at once.
_AT_ONCE = 1 << 17


def removal_steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of n filters, and for each set of filters (a bit mask) and order the step,
    from 0, at which the order removes it; n where it never does."""
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"{n} filters, not between 1 and {MOST_FILTERS}")
    orders = np.array(list(permutations(range(n))))
    position = np.argsort(orders, axis=1)
    fails = np.where(np.arange(1 << n)[:, None] >> np.arange(n) & 1, 0, n)
    steps = np.full((1 << n, len(orders)), n)
    for f in range(n):
        np.minimum(steps, fails[:, f, None] + position[None, :, f], out=steps)
    return orders, steps


def tallies(weights: np.ndarray, orders: np.ndarray, steps: np.ndarray) -> dict[str, np.ndarray]:
    """Counts by part, order and step. weights: parts x sets x (documents, good, toxic)."""
    parts, sets, kinds = weights.shape
    n = orders.shape[1]
    lost = np.zeros((parts, len(orders), n + 1, kinds), np.int64)
    every = np.arange(len(orders))
    for m in range(1, sets):  # an order meets a set in one step, so no place is added to twice
        lost[:, every, steps[m]] += weights[:, m, None]
    lost = lost[:, :, :n]
    removed = lost[..., 0]
    has = np.arange(sets)[:, None] >> np.arange(n) & 1
    failing = weights[..., 0] @ has
    shapley = np.zeros((parts, n), np.int64)
    for s in range(n):
        np.add.at(shapley, (slice(None), orders[:, s]), removed[:, :, s])
    alone = weights[:, 1 << np.arange(n), 0]
    return {
        "kept": weights[..., 0].sum(axis=1)[:, None, None] - removed.cumsum(axis=2),
        "removed": removed,
        "redundant": failing[:, orders] - removed,
        "unique_fails": alone[:, orders],
        "good_lost": lost[..., 1],
        "toxic_lost": lost[..., 2],
        "shapley": shapley[:, orders],
    }


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
REPORT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def _reports(names: str):
    n = len(names)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, steps = removal_steps(n)
        written = np.repeat(["".join(names[f] for f in o) for o in orders], n)
        step = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))
        most = max(1, _AT_ONCE // len(step))
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                sets = batch.column("sets")
                rows = np.repeat(np.arange(batch.num_rows), pc.list_value_length(sets))
                flat = sets.flatten()
                weights = np.zeros((batch.num_rows, 1 << n, 3), np.int64)
                for k, c in enumerate(("n", "good", "toxic")):
                    weights[rows, np.asarray(flat.field("fails")), k] = np.asarray(flat.field(c))
                found = tallies(weights, orders, steps)
                name = pc.take(batch.column("part"), pa.array(np.repeat(np.arange(batch.num_rows), len(step))))
                yield pa.RecordBatch.from_arrays(
                    [name, pa.array(np.tile(written, batch.num_rows), pa.string()), pa.array(np.tile(step, batch.num_rows)),
                     *[pa.array(found[c].reshape(-1)) for c in COUNTS]], names=["part", "filter_order", "step", *COUNTS])

    return report


def interactions(judged: DataFrame, names: str, good: Column, toxic: Column) -> DataFrame:
    """The report for ``judged`` (part string, fails int: bit f set if the filter ``names[f]``
    fails): a row per part, order and step. ``good`` and ``toxic`` are conditions on a row;
    NULL counts as false."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sets = judged.groupBy("part", "fails").agg(F.count("*").alias("n"), one(good).alias("good"), one(toxic).alias("toxic"))
    # at most 2 ** len(names) sets a part
    parts = sets.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))
    return parts.mapInArrow(_reports(names), REPORT)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            points = np.asarray(pc.utf8_length(batch.column("text")))
            fails, digests = np.empty(batch.num_rows, np.int32), []
            for i, raw in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = raw.split()
                capitals = len(raw) - len(raw.translate(None, _CAPITALS))
                fails[i] = ((len(words) < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
                            | (100 * capitals > MOST_CAPITALS * int(points[i])) << 2 | (_SYMBOL.search(raw) is not None) << 3)
                digests.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("part"), pa.array(fails), pa.array(digests, pa.binary())],
                names=["doc_id", "part", "fails", "digest"])


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, part, fails of each of ``docs`` (doc_id, source, text) under the five filters."""
    texts = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(texts.mapInArrow(_judged, JUDGED), "judged")
    # the first document of each text; a text's copies meet in map-side aggregates only
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    repeated = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(firsts, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.col("fails").bitwiseOR(F.when(repeated, REPEATED).otherwise(0)).alias("fails"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of the five filters over ``docs`` (doc_id, source, text) with ``labels``
    (doc_id, quality, toxic): part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley.

    A null text counts as empty, a null source as the part ''. Rows that repeat a doc_id are
    documents of their own; with equal texts neither has the smaller id, so neither repeats the
    other. A row without doc_id repeats nothing, is repeated by nothing and has no label. A
    document labelled more than once is good, or toxic, if one of its labels says so. Other
    columns are left aside. An empty table gives no rows.
    """
    marks = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")))
    judged = judge(docs).join(marks, "doc_id", "left")
    return interactions(judged, NAMES, F.col("good"), F.col("bad"))
