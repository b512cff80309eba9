"""Packing of token sequences: first-fit decreasing over a tournament tree of bin
capacities, run on its own in each randomised group of documents.

A document becomes its token ids and an end id. Every ``length`` ids from its start form
a full sequence; what is left over competes for room in the bins of its group. Only sizes
and checksums are shuffled, never ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import handing_back, slices

LENGTH = 4096
END_ID = 2
#: Documents of a group, on average. A group is one task's work: a few hundred KB.
GROUP_DOCS = 4096
PIECES = "doc_id long, doc_row long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Words after which a worker begins anew to keep their ids, from task to task. The words before them stay
#: until then, so that frequent ones go on: about 200 bytes for each of twice as many.
CACHE = 100_000
#: Bytes of text whose ids are told at once.
TEXTS = 2 << 20
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}]+").fullmatch
_workers: dict[str, WordIds] = {}


class WordIds:
    """Ids of words by a tokenizer that treats white space as a border, so that a text's
    ids are those of its words one after the other.

    Words of lower-case Latin letters skip the tokenizer's normalising and splitting,
    which leave them as they are; its merges give their ids as they do all others."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(vocabulary)
        self.plain = Tokenizer(self.whole.model)  # the vocabulary and merges are there once
        self.whole.encode_special_tokens = True
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, vocabulary: str) -> WordIds:
        return _workers.setdefault(vocabulary, cls(vocabulary)) if vocabulary not in _workers else _workers[vocabulary]

    def __call__(self, words: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = []
        for w in words:
            if w not in known:
                if (ids := older.get(w)) is None:
                    new.append(w)
                else:
                    known[w] = ids
        plain = [w for w in new if _PLAIN(w)]
        for tokenizer, some in ((self.plain, plain), (self.whole, [w for w in new if not _PLAIN(w)])):
            for a in range(0, len(some), 20_000):
                for w, e in zip(part := some[a:a + 20_000], tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                    known[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)
        return [known[w] for w in words]


def ids_of(texts: pa.Array, encode: WordIds) -> list[np.ndarray]:
    """Token ids of each text, without an end id.

    ASCII letters are lowered and parted from ASCII marks (but not from apostrophes) first,
    as the tokenizer would do: fewer words are left to look up."""
    texts = pc.ascii_lower(pc.fill_null(texts, ""))
    for pattern in (f"([{_LETTERS}])([{_MARKS}])", f"([{_MARKS}])([{_LETTERS}])"):
        texts = pc.replace_substring_regex(texts, pattern, r"\1 \2")
    words = pc.ascii_split_whitespace(texts)
    coded = pc.dictionary_encode(words.flatten())
    each = encode(coded.dictionary.to_pylist())
    size = np.fromiter(map(len, each), np.int64, len(each)) // 4
    first = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(each), "<u4")
    word = np.asarray(coded.indices)
    n = size[word]
    ends = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.arange(ends[-1]) + np.repeat(first[word] - ends[:-1], n)]
    at = ends[np.asarray(words.offsets) - words.offsets[0].as_py()]
    return [ids[a:b] for a, b in zip(at, at[1:])]


def _pieces(vocabulary: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row, end = WordIds.of_worker(vocabulary), 0, np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, "text", TEXTS):
                out: list[tuple] = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), ids_of(part.column("text"), encode)):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    out += [(doc_id, row, a, len(p := ids[a:a + length]), zlib.crc32(p.tobytes()), len(ids)) for a in range(0, len(ids), length)]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "doc_row", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, tried from the longest down, ties in the given order.

    ``tree`` is a tournament: a leaf holds the room of a bin, every inner node the larger
    of its children, so the first bin with enough room is found on one way down."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= need
        while node > 1:
            node >>= 1
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def _pack_group(capacity: int):
    def run(key, group):
        group = group.sort_values(["doc_id", "doc_row", "start"], kind="stable").reset_index(drop=True)
        full = (group["length"] == capacity).to_numpy()
        bins, offsets = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
        bins[full] = np.arange(full.sum())
        some, at = first_fit_decreasing(group.loc[~full, "length"].to_numpy(), capacity)
        bins[~full], offsets[~full] = some + full.sum(), at
        group["sequence_id"] = (int(key[0]) << 32) + bins
        group["offset"] = offsets
        return group[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]
    return run


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID,
                   group_docs: int = GROUP_DOCS, seed: int = 17) -> DataFrame:
    """A row for each piece of ``docs`` (doc_id, text) and where it lies.

    A null or empty text is its end id alone. Repeated rows, and rows without doc_id, are
    packed each for itself. Other columns are left aside. An empty table gives no rows.
    Groups are drawn from (doc_id, place in its task), so copies spread evenly too.
    Sequences of one group have ids from ``group << 32`` on; a sequence that is not full
    is padded to ``length`` by whoever writes it.
    """
    docs = docs.select("doc_id", "text")
    groups = max(1, -(-docs.count() // group_docs))
    pieces = docs.mapInArrow(handing_back(_pieces(vocabulary, length, end_id)), PIECES)
    drawn = F.pmod(F.xxhash64("doc_id", "doc_row", F.lit(seed)), F.lit(groups))
    return pieces.withColumn("g", drawn).groupBy("g").applyInPandas(_pack_group(length), PACKED)
