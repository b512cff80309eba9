"""Quality rules in DataFrame operations only: counts of words, symbols, repeated lines and
repeated eight-word windows, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed one- and two-token n-grams, one of the trusted documents and one
of the whole corpus, are counted over all documents. A document's score is the mean, over
its n-grams, of the log ratio of their probabilities; it is kept from a fixed threshold on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Buckets of n-grams: the size of what is collected, whatever the corpus.
BUCKETS = 10_000
#: Words of a window, least words of a document, most words in repeated windows in percent (fixed values).
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
SYMBOLS = r"[#*$%&|<>]+"
#: Letters and digits, or what is neither those nor white space.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
#: Mean log ratio of an n-gram from which on a document is kept. Text like the corpus scores
#: about 0; below -0.1 its n-grams are a tenth rarer in trusted documents than in the corpus.
THRESHOLD = -0.1
SMOOTHING = 0.5


def _covered(starts: Column) -> Column:
    """Words in windows that begin at the ascending ``starts``."""
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["at"])).alias("n"), s.alias("at")),
        lambda a: a["n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (with doc_id, text) reduced to doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and ``tokens`` (buckets). A null text has no words, lines or tokens.

    Windows are compared by a 64-bit hash first; where a hash occurs twice, by their words."""
    t = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.filter(F.split(t, SPACE), lambda w: w != "").alias("words"),
                       F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    last = F.size("words") - (WINDOW - 1)
    hashes = F.when(last > 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    rows = rows.select("*", hashes.alias("hashes"))
    windows = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform(F.sequence(F.lit(1), last), lambda i: F.struct(F.array_join(F.slice("words", i, WINDOW), " ").alias("w"), i.alias("i")))))
    rows = rows.select("doc_id", "text", "words", "lines", windows.alias("windows"))
    same = lambda i, x: F.get("windows", i)["w"].eqNullSafe(x["w"])
    starts = F.sort_array(F.transform(F.filter("windows", lambda x, i: same(i - 1, x) | same(i + 1, x)), lambda x: x["i"]))
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("windows").isNull(), F.lit(0).cast("long")).otherwise(_covered(starts)).alias("n_repeat_words"),
        token_buckets(F.col("text")).alias("tokens"))


def token_buckets(text: Column) -> Column:
    """The bucket of each token, in two bytes."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("smallint"))


def n_grams(buckets: str) -> Column:
    """Buckets of the tokens, and of pairs of neighbours by the tokens' buckets."""
    pair = lambda i: F.pmod(F.xxhash64(F.get(buckets, i), F.get(buckets, i + 1)), F.lit(BUCKETS)).cast("smallint")
    two = F.transform(F.sequence(F.lit(0), F.size(buckets) - 2), pair)
    return F.when(F.size(buckets) > 1, F.concat(buckets, two)).otherwise(F.col(buckets))


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """For each bucket log p(trusted) - log p(corpus), counted over all ``docs``; all 0 where
    nothing is trusted. Each bucket's count grows by ``SMOOTHING`` of the mean count, so that the
    smaller of the two multinomials is not flattened more than the other.

    ``trusted``: distinct doc_id. It grows with the corpus, so both sides are shuffled, at every
    size alike; documents travel as two bytes a token, unsorted. Buckets are summed on the map side."""
    tokens = docs.select("doc_id", token_buckets(F.coalesce("text", F.lit(""))).alias("tokens"))
    marked = tokens.join(trusted.withColumn("trusted", F.lit(1)).hint("shuffle_hash"), "doc_id", "left")
    counted = (marked.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(n_grams("tokens")).alias("bucket"))
               .groupBy("bucket").agg(F.count("*").alias("n"), F.sum("trusted").alias("good")).collect())
    counts = np.zeros((2, BUCKETS))
    for b, n, good in counted:
        counts[:, b] += good, n
    if not counts[0].any():
        return np.zeros(BUCKETS)
    shares = counts / counts.sum(axis=1, keepdims=True) + SMOOTHING / BUCKETS
    return np.log(shares[0]) - np.log(shares[1])


def score_documents(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text): counts, base_failed, score, kept.

    ``trusted``: doc_id of trusted documents; nulls and repeated ids are left out. A document
    without tokens scores 0. Where no document is trusted every score is 0 and only the base
    rules decide. Repeated rows are counted and returned each for itself. Other columns are
    left aside. An empty table gives no rows.
    """
    trusted = trusted.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    model = F.lit(log_ratios(docs, trusted))
    rows = word_counts(docs)
    rows = rows.select(*rows.columns[:-1], n_grams("tokens").alias("grams"))
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(model, g))
    score = F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(0.0)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = rows.select(*rows.columns[:-1], failed.alias("base_failed"), score.alias("score"))
    return rows.select("*", (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"))
