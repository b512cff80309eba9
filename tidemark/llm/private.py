"""Personal data: four fixed patterns, and spans that boosted trees add.

Generators with high recall propose overlapping spans; gradient-boosted trees judge their format
and context; a threshold for each kind, calibrated on candidates that the trees did not see,
selects what is added. The trees learn from a bounded sample of documents (``SAMPLE``): what
the patterns find there counts as personal, with the same data in other notations, and what
they don't, with damaged copies, as not. All documents are then searched over their whole texts.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds, in the order in which those with equal starts are listed.
KINDS = ["email", "ip", "card", "phone", "account"]
#: The base patterns (fixed values). Possessive repeats and look-behinds keep them linear; they match the same.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What proposes candidates.
AT, DOT = r"(?:@|\s?\(at\)\s?|\s?\[at\]\s?|\sat\s)", r"(?:\.|\s?\(dot\)\s?|\s?\[dot\]\s?|\sdot\s)"
PROPOSED = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}"),
    "number": re.compile(r"(?<![A-Za-z0-9])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9]){6,23}(?![A-Za-z0-9])"),
    "account": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
}
CONTEXT = [re.compile(p, re.I) for p in (r"mail|contact|write", r"phone|tel|call|fax|mobil", r"card|visa|credit|pay", r"\bip\b|host|server|address", r"iban|account|konto|bank", r"no\.|nr\.|id\b|version|page|isbn|order")]
#: Documents that the trees learn from, and candidates of one document in that sample.
SAMPLE, EACH = 20_000, 50
TREES, DEPTH, RATE, BINS, SHRINK = 60, 3, 0.2, 32, 1.0
PRECISION = 0.98
#: Made examples of each kind, and parts of the rows each of which is judged by trees grown on the others.
MADE, FOLDS = 150, 3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns by start, then kind, in code points."""
    out: list[tuple[int, int, str]] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() < 40 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _octets(text: str) -> bool:
    """Whether the text is four numbers of at most 255."""
    return bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", text)) and all(int(o) < 256 for o in text.split("."))


def _kind(proposed: str, text: str) -> str:
    if proposed != "number":
        return proposed
    if _octets(text):
        return "ip"
    return "card" if len(_digits(text)) >= 12 and "+" not in text else "phone"


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all that the generators propose; they may overlap."""
    return [(m.start(), m.end(), _kind(name, m[0])) for name, p in PROPOSED.items() for m in p.finditer(text)]


def features(found: str, kind: str, before: str, after: str) -> list[int]:
    """Format and context of a span, as small numbers; ``before`` and ``after`` are its neighbourhood."""
    d = _digits(found)
    parts = [p for p in re.split(r"[^A-Za-z0-9]+", found) if p]
    last = parts[-1] if parts else ""
    count = lambda chars: sum(found.count(c) for c in chars)
    side = lambda c: 0 if not c else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c.isspace() else 4
    octets = found.split(".")
    return [min(BINS - 1, x) for x in (
        KINDS.index(kind), len(found) // 2, len(d), len(parts), min(map(len, parts), default=0), max(map(len, parts), default=0), len(last),
        int(last.isalpha()), count("."), count("- "), count("()"), count("/"), int(found[:1] == "+"), int(len(set(d)) <= 2) + int(len(set(d)) <= 4), int(12 <= len(d) <= 19 and luhn(d)),
        int(kind == "ip" and all(o.isdigit() and len(o) < 4 and int(o) < 256 for o in octets)), int(bool(re.search(r"\b(?:19|20)[0-9]{2}\b", found))),
        int("@" in found) + 2 * int(bool(re.search(r"[(\[]at[)\]]", found))) + 4 * int(" dot " in found), int(_account(found)) if kind == "account" else 2,
        side(before[-1:]), side(after[:1]), *(int(bool(c.search(before))) for c in CONTEXT))]


def _account(text: str) -> bool:
    """Whether the check digits of an account number fit."""
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _row(text: str, start: int, end: int, kind: str) -> list[int]:
    return features(text[start:end], kind, text[max(0, start - 30):start], text[end:end + 10])


def _variants(found: str, kind: str) -> list[tuple[str, str, int]]:
    """(text, kind, label): the same data in other notations, and damaged copies."""
    other = lambda t: "".join(str((int(c) + 1) % 10) if i == len(t) - 1 and c.isdigit() else c for i, c in enumerate(t))
    number = lambda t, label: (t, _kind("number", t), label)
    if kind == "email":
        name, _, host = found.partition("@")
        return [(v, kind, label) for v, label in (
            (f"{name} (at) {host}", 1), (f"{name} [at] " + host.replace(".", " [dot] "), 1), (f"{name} at " + host.replace(".", " dot "), 1), (f"{name} at " + host, 0), (f"{name}@" + host.rpartition(".")[2] + ".0", 0))]
    if kind == "ip":
        return [number(re.sub(r"[0-9]+", lambda m: str(int(m[0][-5:]) + 256), found), 0), number(found.replace(".", "-"), 0)]
    d = _digits(found)
    if kind == "card":
        cut = [d[i:i + 4] for i in range(0, len(d), 4)]
        return [number(v, label) for v, label in (("-".join(cut), 1), (" ".join(cut), 1), (".".join(cut), 1), (other(d), 0), (other(found), 0), (".".join([*cut[:-1], other(cut[-1])]), 0), (d[:9], 0), (d + d[:7], 0))]
    if kind == "account":
        flat = found.replace(" ", "")
        cut = " ".join(flat[i:i + 4] for i in range(0, len(flat), 4))
        wrong = [flat[:k] + str((int(flat[k]) + 1) % 10) + flat[k + 1:] for k in (2, len(flat) - 1) if flat[k].isdigit()]
        return [(flat, kind, 1), (cut, kind, 1), *[(w, kind, 0) for w in wrong], *[(" ".join(w[i:i + 4] for i in range(0, len(w), 4)), kind, 0) for w in wrong]]
    national = re.sub(r"^\+[0-9]{1,3}[ ().-]+", "", found)
    own = re.sub(r"^\+[0-9]{1,3}?(?=[0-9]{10}$)", "", "+" + d)
    forms = [(found.lstrip("+"), 1), (f"({own[:3]}) {own[3:6]}-{own[6:]}", 1), (".".join((own[:3], own[3:6], own[6:])), 1), (f"{own[:3]}-{own[3:6]}-{own[6:]}", 1)]
    if national != found and len(_digits(national)) >= 9:
        forms.append((national, 1))
    return [number(v, label) for v, label in [*forms, (f"{d[:4]}-{d[4:6]}-{d[6:8]}", 0), (d[:8], 0), (d, 0)]]


def shape(text: str, kind: str) -> str:
    """What a text looks like: its digits and letters alike; of addresses what stands for @ and dots."""
    if kind == "email":
        return kind + re.sub(r"[A-Za-z0-9_%+-]+", "a", re.sub(r"\b(?:at|dot)\b", "*", text))
    return kind + re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", text))


#: Countries of made account numbers, and the length of what follows their check digits (fixed values).
ACCOUNTS = {"DE": 18, "FR": 23, "ES": 20, "NL": 14, "GB": 18, "AT": 16}
#: What stands before made examples; half of them have a neutral text (fixed values).
SAID = {"email": ["mail to ", "write: ", "contact "], "card": ["pay with ", "card no. ", "visa "], "phone": ["call ", "tel. ", "phone: "], "account": ["iban ", "account ", "konto "], "ip": ["host "]}
NEUTRAL = ["and then ", "see ", "it was ", "with ", ", "]


def made_examples(kind: str, count: int, seed: int = 31) -> list[tuple[str, str]]:
    """(text before, personal data in its plain notation) by chance, always the same."""
    rnd = random.Random(f"{kind}{seed}")
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rnd.choice("abcdefghijklmnoprstuvwz") for _ in range(rnd.randrange(2, 9)))
    out = []
    for k in range(count):
        if kind == "email":
            text = f"{name()}{rnd.choice(['', '.', '_', digits(2)])}{name()}@{name()}{rnd.choice(['', digits(1)])}.{rnd.choice(['com', 'org', 'example.net', 'de', 'co.uk'])}"
        elif kind == "card":
            d = rnd.choice("3456") + digits(14)
            text = next(d + c for c in "0123456789" if luhn(d + c))
        elif kind == "account":
            country = rnd.choice(sorted(ACCOUNTS))
            own = digits(ACCOUNTS[country]) if country not in ("GB", "NL") else "".join(rnd.choice("ABCDEFGHKLMNPRSTUVWX") for _ in range(4)) + digits(ACCOUNTS[country] - 4)
            text = country + f"{98 - int(''.join(str(int(c, 36)) for c in own + country + '00')) % 97:02d}" + own
        else:
            code, own = rnd.choice(["1", "44", "49", "33", "351"]), (rnd.choice("23456789") + digits(9))
            text = f"+{code}" + rnd.choice([f" {own[:3]} {own[3:6]} {own[6:]}", f" ({own[:3]}) {own[3:6]}-{own[6:]}", f"-{own[:3]}-{own[3:6]}-{own[6:]}", own])
        out.append((rnd.choice(SAID[kind] if k % 2 else NEUTRAL), text))
    return out


def made_rows(count: int = MADE) -> list[tuple[int, bytes, int, str, bool]]:
    """Rows to learn from, as of :func:`_sampled`, of ``count`` made examples of each kind that can be added."""
    rows = []
    for kind in ("email", "card", "phone", "account"):
        for k, (before, text) in enumerate(made_examples(kind, count)):
            after = (" today", ", ", ".", "")[k % 4]
            for v, of, label in [(text, kind, 1), *_variants(text, kind)]:
                rows.append((k, bytes(features(v, of, before, after)), label, shape(v, of), False))
    return rows


@dataclass
class Trees:
    """Complete trees of ``DEPTH`` levels: feature and border of each inner node, value of each leaf."""

    feature: np.ndarray
    border: np.ndarray
    value: np.ndarray
    start: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, b, v in zip(self.feature, self.border, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, f[node]] > b[node])
            out += v[node - (2 ** DEPTH - 1)]
        return out


def boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Trees:
    """Gradient boosting of the log loss; splits by sums of gradients over each feature's values."""
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    start, inner = float(np.log(share / (1 - share))), 2 ** DEPTH - 1
    margin, parts = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, border, node = np.zeros(inner, np.int64), np.full(inner, BINS), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first = 2 ** level - 1
            for k in range(first, 2 * first + 1):
                own = np.flatnonzero(node == k)
                best = 1e-6
                for f in range(x.shape[1]):
                    gs = np.cumsum(np.bincount(x[own, f], g[own], BINS))
                    hs = np.cumsum(np.bincount(x[own, f], h[own], BINS))
                    gain = gs ** 2 / (hs + SHRINK) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + SHRINK) - gs[-1] ** 2 / (hs[-1] + SHRINK)
                    if (b := int(gain.argmax())) < BINS - 1 and gain[b] > best:
                        best, feature[k], border[k] = gain[b], f, b
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > border[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + SHRINK)
        margin += value[leaf]
        parts.append((feature, border, value))
    stack = [np.array(v) for v in zip(*parts)] if parts else [np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1))]
    return Trees(*stack, start)


@dataclass
class Model:
    trees: Trees
    thresholds: dict[str, float]


def thresholds(margin: np.ndarray, y: np.ndarray, kinds: np.ndarray) -> dict[str, float]:
    """For each kind the lowest margin from which on ``PRECISION`` of the unseen candidates are
    personal, two more counting as not, and never a margin under 0; kinds that never reach it add nothing."""
    out = {}
    for k, kind in enumerate(KINDS):
        own = np.flatnonzero(kinds == k)
        own = own[np.argsort(-margin[own], kind="stable")]
        right = np.cumsum(y[own])
        good = (right / (np.arange(len(own)) + 2) >= PRECISION) & (np.append(margin[own][1:], -np.inf) < margin[own]) if len(own) else np.zeros(0, bool)
        out[kind] = max(0.0, float(margin[own][np.flatnonzero(good)[-1]])) if good.any() else float("inf")
    return out


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for draw, text in zip(batch.column("draw").to_pylist(), batch.column("text")):
            t = text.as_py() or ""
            base = base_spans(t)
            some = [(_row(t, s, e, k), 1, shape(t[s:e], k), False) for s, e, k in base[:EACH]]
            for s, e, k in base[:EACH]:
                some += [(features(v, of, t[max(0, s - 30):s], t[e:e + 10]), label, shape(v, of), False) for v, of, label in _variants(t[s:e], k)]
            # of the corpus and not found by the patterns; open to doubt unless check digits tell
            some += [(_row(t, s, e, k), 0, shape(t[s:e], k), not _refuted(t[s:e], k)) for s, e, k in candidates(t)[:EACH] if not any(a < e and s < b for a, b, _ in base)]
            rows += [(draw, bytes(x), *rest) for x, *rest in some]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()))], ["draw", "x", "y", "shape", "doubt"])


def _refuted(text: str, kind: str) -> bool:
    """Whether check digits say that a candidate is none."""
    return kind == "card" and not luhn(_digits(text)) or kind == "account" and not _account(text)


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 23, made: int = MADE) -> Model:
    """Learns from at most about ``sample`` documents, drawn by a hash, and ``made`` made examples of
    each kind. Thresholds come from margins of trees that did not see the candidate's document."""
    rate = min(1.0, sample / max(1, docs.count()))
    rows = docs.select(F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11).alias("draw"), "text").where(F.col("draw") <= int(rate * 2 ** 53))
    found = sorted(map(tuple, rows.where(F.col("text").rlike("[0-9@]|dot|IBAN")).mapInArrow(_sampled, "draw long, x binary, y long, shape string, doubt boolean").collect()))
    if not found:
        return Model(boosted(np.zeros((0, 1), np.uint8), np.zeros(0), 0), dict.fromkeys(KINDS, float("inf")))
    found += made_rows(made)
    personal = {r[3] for r in found if r[2]}
    found = [r for r in found if not (r[4] and r[3] in personal)]
    x = np.array([list(r[1]) for r in found], np.int64)
    y = np.array([r[2] for r in found], float)
    fold = np.array([r[0] for r in found]) % FOLDS
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        margin[fold == k] = boosted(x[fold != k], y[fold != k]).margin(x[fold == k])
    return Model(boosted(x, y), thresholds(margin, y, x[:, 0]))


_ANY = re.compile(r"[0-9@]|\bdot\b|[(\[]at[)\]]")


def all_spans(text: str, model: Model) -> tuple[list, list]:
    """(base spans, base and added spans), each by start, then kind. Added spans touch no other;
    of those that overlap the one with the larger margin stays."""
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    spans = sorted(base)
    new = candidates(text)
    reach = np.maximum.accumulate([e for _, e, _ in spans]) if spans else np.empty(0, np.int64)
    starts = [s for s, *_ in spans]
    # spans that begin before the candidate's end reach into it if the furthest of them does
    new = [(s, e, k) for s, e, k in new if not (n := int(np.searchsorted(starts, e))) or reach[n - 1] <= s]
    if not new:
        return base, base
    margin = model.trees.margin(np.array([_row(text, *c) for c in new], np.int64))
    taken: list[tuple[int, int, str]] = []  # in order; none touches another
    for i in np.argsort(-margin, kind="stable").tolist():
        s, e, k = new[i]
        if margin[i] >= model.thresholds[k]:
            at = bisect_left(taken, (e,))
            if not at or taken[at - 1][1] <= s:
                insort(taken, new[i])
    return base, sorted(base + taken, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_private(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each of ``docs`` (doc_id, text).

    A null text is searched as an empty one; repeated rows are searched each for itself; other
    columns are left aside; no rows give none. Positions are code points, ends exclusive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t.as_py() or "", model) for t in batch.column("text")]
            count = lambda kind: pa.array([sum(k == kind for *_, k in b) for b, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *map(count, KINDS[:4]), pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string()), pa.array([written(s) for _, s in found], pa.string())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
