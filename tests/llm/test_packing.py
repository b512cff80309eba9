"""Packing against a plain tokenizer run and a first-fit that tries every bin."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import WordIds, first_fit_decreasing, ids_of, pack_documents

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["a  b\x0bc\n d's 've!'re", "<|endoftext|> x<|startoftext|>", "ÄÖ.ß!ŷ1≠x ≮ İstanbul.ΑΣ. ΑΣ", None, "",
         "é. .́a ≮ 12,3.4 it'S 'LL x'll!!y", " a b\x85c\x1cd ", "a" * 3000, "word " * 9000, "THE END.", "  \n"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


def test_ids_are_the_tokenizers(tokenizer):
    got = ids_of(pa.array(TEXTS), WordIds(VOCABULARY))
    assert [x.tolist() for x in got] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_first_fit_is_that_of_a_plain_search():
    lengths = np.random.default_rng(3).integers(1, 100, 500)
    bins, offsets = first_fit_decreasing(lengths, 100)
    room, want = [], np.zeros(500, int)
    for i in np.argsort(-lengths, kind="stable"):
        want[i] = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        if want[i] == len(room):
            room.append(100)
        room[want[i]] -= lengths[i]
    assert bins.tolist() == want.tolist()
    for b in set(bins):
        own = sorted((o, n) for o, n in zip(offsets[bins == b], lengths[bins == b]))
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()


def test_every_id_lies_in_one_piece(spark, tokenizer):
    rows = [(i, t, "clash", 0) for i, t in enumerate(TEXTS)] + [(None, "x y", "", 1), (3, "again", "", 1), (3, "again", "", 1)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string, g string, length long"), VOCABULARY, group_docs=4).toPandas()
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t, *_ in rows]
    assert got["length"].sum() == sum(map(len, want)) and got["length"].max() == 4096
    for i, ids in enumerate(want[:-3]):
        if i == 3:
            continue
        own = got[got.doc_id == i].sort_values("start")
        assert own.start.tolist() == np.cumsum([0, *own.length])[:-1].tolist() and set(own.doc_tokens) == {len(ids)}
        assert own.ids_crc32.tolist() == [zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes()) for a, n in zip(own.start, own.length)]
    assert (got.doc_id == 3).sum() == 3 and got.doc_id.isna().sum() == 1
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == np.cumsum([0, *s.length])[:-1].tolist() and s.length.sum() <= 4096


def test_no_rows(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0
