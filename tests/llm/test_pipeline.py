"""The stages on planted documents, and the whole pipeline over a given table."""

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from conftest import SF001
from tidemark.llm.queries import table, vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage keeps, from the given documents and some planted ones."""
    given = [(*r, "e") for r in table(spark, SF001, "documents").collect()]
    text = next(r for r in given if r[2] == "en" and 900 < r[4] < 2500)[1].replace("\n", " ")
    item = table(spark, SF001, "benchmark").first().text
    key = "f" * 3 + "0123456789abcdef" * 2
    rows = given + [(10_000, None, "en", "s", None, None), (10_001, "", None, "s", 0, "e"), (10_002, "123 ###", "en", "s", 7, "e"),
                    (10_003, text + " tail", "en", "s", 5, "e"), (10_004, text + " other end", "en", "s", 5, "e"), (10_005, item, None, "s", 5, "e"),
                    (10_006, f"one clean line about nothing {key} and some more of it", "en", "s", 5, "e"), (None, "no id but words", "en", "s", 5, "e"), (10_007, "twice the same number here", "en", "s", 5, "e"), (10_007, "twice but other words follow", "en", "s", 5, "e")]
    docs, out = spark.createDataFrame(rows, SCHEMA), {}
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, SF001), name)
        out[name] = docs
    return rows, out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages(steps):
    rows, out = steps
    assert list(out) == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]
    before = {r[0] for r in rows}
    told, near, clean, safe = (out[n] for n in list(out)[:4])
    assert before - ids(told) == {10_000, 10_001, 10_002}
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"] for d in (told, near, clean, safe))
    assert not {10_003, 10_004} & ids(near) and None in ids(near) and near.where("doc_id = 10007").count() == 1
    assert 10_005 in ids(near) and 10_005 not in ids(clean) and 10_006 in ids(clean)
    assert ids(safe) == ids(clean) and safe.count() == clean.count()
    r = safe.where("doc_id = 10006").first()
    assert r.text == "one clean line about nothing [secret] and some more of it" and r.n_chars == len(r.text) and r.extra == "e"


def test_packed(steps):
    _, out = steps
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    want = sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in out["secrets"].collect())
    assert out["packing"].agg({"length": "sum"}).first()[0] == want


def test_run(spark):
    got = P.run(spark, SF001)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 100


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.count() == 0
