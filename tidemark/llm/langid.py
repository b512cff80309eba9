"""Language identification: multinomial logistic regression on TF-IDF of hashed character
n-grams, trained with follow-the-regularised-leader under elastic-net penalties, with
a temperature fitted on documents that the training did not see.

Document frequencies are counted over all learnable rows. The weights are fitted on a bounded
sample of them (``SAMPLE`` rows, spread evenly over the languages, drawn by a hash of doc_id);
every document is then scored over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed n-grams: bits, and the lengths that are taken.
BITS, LENGTHS = 15, (1, 2, 3)
SIZE = 1 << BITS
#: Rows that the weights are fitted on, all languages together: the bound of what is collected.
SAMPLE = 3000
#: Follow the regularised leader: rate, smoothing, penalties of absolute and squared weights, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.5, 4
UNDETERMINED = "und"
#: N-grams of a text (about three a letter) below which its score says too little to reject it.
EVIDENCE = 60
#: The limit of the score: so much of what held-back rows reach, all but this share of them, and
#: between these multiples of a blind guess and this value.
LIMIT_OF, LIMIT_ROWS, LIMIT_LEAST, LIMIT_MOST = 0.9, 0.005, 1.25, 0.6
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _letters() -> np.ndarray:
    """Lower case of each letter of the basic plane, 0 for all that is no letter."""
    table = np.zeros(1 << 16, np.uint32)
    for i in range(1 << 16):
        if (c := chr(i)).isalpha():
            table[i] = ord(c.lower()) if len(c.lower()) == 1 else i
    return table


_table: list[np.ndarray] = []


def n_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, occurrences) of the text's n-grams; what lies between letters counts as one blank."""
    if not _table:
        _table.append(_letters())
    code = _table[0][np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)]
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]
    found, gram = [], np.zeros(len(code), np.uint32)
    for n in LENGTHS:
        if len(code) >= n:
            gram = (gram[:len(code) - n + 1] + code[n - 1:]) * _MULTIPLIERS[(n - 1) % 3]
            gram ^= gram >> np.uint32(13)
            found.append((gram * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS))
    counts = np.bincount(np.concatenate(found), minlength=SIZE)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from (a null id counts as an empty one)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


@dataclass
class Model:
    """``weights``: a row for each bucket, the last for the bias; a column for each language."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0
    #: Score below which a text is in no learned language; chosen on held-back rows.
    least: float = 0.0

    def values(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[at]
        return (x / (np.sqrt(x @ x) or 1)).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        at, counts = n_grams(text)
        z = (self.values(at, counts) @ self.weights[at] + self.weights[-1]) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


    def known(self, text: str | None, least: float | None = None) -> bool:
        """Whether the text is in a learned language: it has a letter, and unless it is very short
        its score reaches the limit."""
        lang, score = self.predict(text)
        if lang == UNDETERMINED:
            return False
        return score >= (self.least if least is None else least) or int(n_grams(text)[1].sum()) < EVIDENCE


def score_limit(scores: np.ndarray, classes: int) -> float:
    """A limit that texts of the learned languages reach, from the scores of held-back rows. A blind
    guess scores 1 / classes, and noise and other languages little more."""
    low, high = min(LIMIT_LEAST / classes, LIMIT_MOST), LIMIT_MOST
    if not len(scores):
        return low
    return min(max(LIMIT_OF * float(np.sort(scores)[int(LIMIT_ROWS * len(scores))]), low), high)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(SIZE + 1, np.int64)  # the last counts documents
    for batch in batches:
        for text in batch.column("text"):
            at, _ = n_grams(text.as_py())
            df[at] += 1
            df[-1] += 1
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["bucket", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for lang, draw, text in zip(batch.column("lang").to_pylist(), batch.column("draw").to_pylist(), batch.column("text")):
            at, counts = n_grams(text.as_py())
            rows.append((lang, draw, at.astype("<u4").tobytes(), counts.astype("<u4").tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary(), pa.binary()))], ["lang", "draw", "at", "counts"])


def leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights by follow the regularised leader, coordinate by coordinate, over ``rows`` of
    (buckets, values, class) in the given order; penalties leave rare buckets at 0."""
    z, n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def solved(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for at, x, y in rows:
            at, x = np.append(at, SIZE), np.append(x, 1.0)
            own_z, own_n = z[at], n[at]
            w = solved(own_z, own_n)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            n[at] = own_n + g * g
            z[at] = own_z + g - (np.sqrt(n[at]) - np.sqrt(own_n)) / ALPHA * w
    return solved(z, n).astype(np.float32)


def best_temperature(scores: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search of its logarithm.

    One row in n + 2 counts as of any language, so that a few rows that are all told right
    don't make the model certain."""
    other = 1 / (len(scores) + 2)

    def loss(t):
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        target = (1 - other) * s[np.arange(len(s)), classes] + other * s.mean(axis=1)
        return float((np.log(np.exp(s).sum(axis=1)) - target).mean())

    a, b, r = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 11) -> Model:
    """Learns from ``text`` and ``lang`` of the rows of ``docs`` that are not held out, whose
    lang is not null and whose text has a letter. Without such rows the model knows no language."""
    rows = docs.where(F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    counted = rows.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    df = np.zeros(SIZE + 1)
    for bucket, n in counted:
        df[bucket] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("lang").count().collect())
    languages = [lang for lang, _ in sizes]
    if not languages:
        return Model([], idf, np.zeros((SIZE + 1, 0), np.float32))
    each = max(1, sample // len(languages))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11)
    limit = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(int(min(1.0, each / n) * 2 ** 53))) for lang, n in sizes])
    some = rows.select("text", "lang", draw.alias("draw")).where(F.col("draw") <= limit)
    drawn = sorted(map(tuple, some.mapInArrow(_sampled, "lang string, draw long, at binary, counts binary").collect()), key=lambda r: r[1:])
    model, seen, learn, check = Model(languages, idf, np.zeros((SIZE + 1, len(languages)), np.float32)), dict.fromkeys(languages, 0), [], []
    enough: list[bool] = []
    for lang, _, at, counts in drawn:
        seen[lang] += 1
        if seen[lang] <= 2 * each:  # a draw is rarely far over its mean
            at = np.frombuffer(at, "<u4").astype(np.int64)
            counts = np.frombuffer(counts, "<u4")
            row = (at, model.values(at, counts), languages.index(lang))
            if seen[lang] % 5:
                learn.append(row)
            else:
                check.append(row)
                enough.append(counts.sum() >= EVIDENCE)
    model.weights = leader(learn, len(languages))
    if check and len(languages) > 1:
        scores = np.array([x @ model.weights[at] + model.weights[-1] for at, x, _ in check])
        model.temperature = best_temperature(scores, np.array([y for *_, y in check]))
        p = np.exp((scores - scores.max(axis=1, keepdims=True)) / model.temperature)
        model.least = score_limit((p.max(axis=1) / p.sum(axis=1))[np.array(enough)], len(languages))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each of ``docs`` (doc_id, text); other columns are left aside.

    A text that is null or has no letter, and any text if the model knows no language, gives
    `und` with score 0. Repeated rows are scored each for itself; no rows give none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, in a learned language: with a letter and, unless they are
    shorter than ``EVIDENCE``, a score of ``least`` or more (default: the model's own limit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.known(t.as_py(), least) for t in batch.column("text")], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
