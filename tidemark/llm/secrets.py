"""Secret scans in DataFrame operations only: three fixed patterns, and long tokens that a
character Markov model of random strings explains better than one of ordinary identifiers.

Both models are first-order. Random strings are learned from what the patterns find and from
a digest of every document's id in hexadecimal and base 64; ordinary identifiers from
every other token of twelve characters or more. Both are counted over all documents and reduced
to one log ratio for each pair of characters. A token's score is its pairs' mean.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns (fixed values), in the order in which kinds with equal starts are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
ASSIGN_LEAST = 6
#: Tokens the models judge, an equals sign before them or not (up to two after them are padding, but
#: not before a further token), and those ordinary identifiers are learned from: none after an equals
#: sign, where values that ``ASSIGN`` finds would count as ordinary too.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?!=*[A-Za-z0-9+/_-]))?"
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_]{12,}+(?![A-Za-z0-9+/_=-])"
#: Mean log ratio of a pair of characters from which on a token counts as random.
THRESHOLD = 0.5
STATES = 128
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
MARK = "[secret]"


def _found(text: str, pattern: str, kind: str, keep=None) -> Column:
    """Spans (code points) of the pattern's matches: what lies between them comes from
    ``split``, so that lengths add up to positions. ``keep(i)`` tells whether match i stays."""
    rank = KINDS.index(kind)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(text, pattern).alias("gap"), matches.alias("match"))
    start = lambda a, x: a["at"] + F.length(x["gap"])
    spans = F.aggregate(
        F.filter(both, lambda x: x["match"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")),
        lambda a, x: F.struct(
            (start(a, x) + F.length(x["match"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(start(a, x).alias("start"), F.lit(rank).alias("rank"), (start(a, x) + F.length(x["match"])).alias("end"), F.lit(kind).alias("kind")))).alias("out")),
        lambda a: a["out"])
    spans = F.filter(spans, keep) if keep else spans
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPAN))


def base_spans(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` (doc_id, text and ``keep``) with ``text`` non-null and ``base``: spans by start, then kind."""
    rows = docs.select(*keep, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))
    assign = _found("text", ASSIGN, "assign", lambda x, i: F.length(F.get(values, i)) >= ASSIGN_LEAST)
    rows = rows.select("*", assign.alias("a"), _found("text", ACCESS, "access").alias("k"), _found("text", HEX, "hex").alias("h"))
    return rows.select(*keep, "doc_id", "text", F.sort_array(F.concat("a", "k", "h")).alias("base"))


def _pairs(token: str) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(token) - 1), lambda i: F.substr(token, i, F.lit(2)))


def markov_ratios(docs: DataFrame) -> np.ndarray:
    """log p(random) - log p(ordinary) of the second character after the first, for pairs of
    ASCII characters, from all ``docs``. What is collected has at most a row for each pair."""
    text = F.coalesce("text", F.lit(""))
    secret = F.concat(F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 16),
                      F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(text, F.lit(HEX), F.lit(0)))
    digest = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 512)
    drawn = F.array(digest, F.substring(F.base64(F.unhex(digest)), 1, 80))
    names = F.filter(F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0)), lambda t: ~t.rlike(f"{HEX}|{ACCESS}"))
    tokens = docs.select(F.explode(F.array(
        F.struct(F.lit(1).alias("random"), F.concat(secret, drawn).alias("tokens")),
        F.struct(F.lit(0).alias("random"), names.alias("tokens")))).alias("x")).select("x.random", F.explode("x.tokens").alias("token"))
    counted = (tokens.where(F.length("token") > 1).select("random", F.explode(_pairs("token")).alias("pair"))
               .groupBy("random", "pair").count().collect())
    counts = np.zeros((2, STATES, STATES))
    used = sorted({ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=."})
    for random, pair, n in counted:
        if max(map(ord, pair)) < STATES:
            counts[random, ord(pair[0]), ord(pair[1])] += n
    shares = counts[:, used][:, :, used] + 1.0
    shares /= shares.sum(axis=2, keepdims=True)
    ratios = np.zeros((STATES, STATES))
    ratios[np.ix_(used, used)] = np.log(shares[1]) - np.log(shares[0])
    return ratios


def scan_secrets(docs: DataFrame, *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each of ``docs`` (doc_id, text): ``keep``, doc_id, text (null made empty), ``base``
    and ``spans``, arrays of (start, rank, end, kind) by start, then kind.

    ``spans`` has the base spans and those long tokens that touch none of them and whose mean
    log ratio reaches ``threshold``. Repeated rows are scanned each for itself; other columns
    are left aside; an empty table gives no rows. Positions are code points, ends exclusive.
    """
    model = F.lit(markov_ratios(docs).ravel())
    rows = base_spans(docs, *keep)
    rows = rows.select("*", _found("text", CANDIDATE, "random").alias("long"))
    code = lambda t, i: F.ascii(F.substr(t, i, F.lit(1)))
    mean = lambda t: F.aggregate(
        F.sequence(F.lit(1), F.length(t) - 1), F.lit(0.0),
        lambda a, i: a + F.get(model, code(t, i) * STATES + code(t, i + 1))) / (F.length(t) - 1)
    token = lambda x: F.substr("text", x["start"] + 1, x["end"] - x["start"])
    free = F.filter("long", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    rows = rows.select(*keep, "doc_id", "text", "base", free.alias("free"))
    more = F.filter("free", lambda x: mean(token(x)) >= threshold)
    return rows.select(*keep, "doc_id", "text", "base", F.sort_array(F.concat("base", more)).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: str, spans: str) -> Column:
    """The text with ``MARK`` in place of each span, one for spans that overlap."""
    step = lambda a, x: F.when(x["end"] <= a["at"], a).otherwise(F.struct(
        x["end"].alias("at"),
        F.when(x["start"] < a["at"], a["out"])
        .otherwise(F.concat(a["out"], F.substr(text, a["at"] + 1, x["start"] - a["at"]), F.lit(MARK))).alias("out")))
    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(done)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with ``MARK`` in place of each secret of ``text``."""
    rows = scan_secrets(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text"), "_row")
    text = F.when(F.size("spans") == 0, F.col("_row")["text"]).otherwise(redacted("text", "spans"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
