"""What the pipeline's stages send to Python workers, and get back, comes in bounded batches."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as P
from conftest import SF001
from tidemark.llm import common as C
from tidemark.llm import jaccard as J

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def session(spark):
    yield spark
    spark.conf.unset(LIMIT)


@pytest.mark.parametrize("name", ["language_id", "near_duplicates", "decontamination", "packing"])
def test_batches_of_a_stage(session, name):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    session.conf.set(LIMIT, str(64 << 20))
    docs = session.createDataFrame([(k, f"word{k} two three", "en", "s", 5) for k in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    dict(P.STAGES)[name](session, docs, SF001)
    long = session.range(0, 100, 1, 1).selectExpr("id", "repeat(cast(id % 10 as string), 200000) AS text")
    found = [n for n, in long.mapInArrow(sizes, "n long").collect()]
    assert len(found) >= 4 and max(found) < C.WORKER_BYTES + 500_000


def test_lower_limit_stays(session):
    session.conf.unset(LIMIT)
    C.small_batches(session)
    assert session.conf.get(LIMIT).rstrip("b") == str(C.WORKER_BYTES)
    for given, left in ((1000, 1000), (64 << 20, C.WORKER_BYTES), ("64m", C.WORKER_BYTES)):
        session.conf.set(LIMIT, str(given))
        C.small_batches(session)
        assert session.conf.get(LIMIT).rstrip("b") == str(left)


def test_rare_shingles_in_bounded_batches():
    texts = [" ".join(f"w{k}x{i}" for i in range(20_000)) for k in range(3)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), pa.array(texts)], ["doc", "label", "text"])
    frequent = [lambda x: np.ones(len(x), bool)] * 4
    found = list(J._rarest(4, 85, frequent)(iter([batch])))
    assert max(b.num_rows for b in found) <= 100_000 < sum(b.num_rows for b in found)
    rows = [r for b in found for r in zip(*(c.to_pylist() for c in b.columns))]
    want = []
    for doc, text in zip((1, 2, 3), texts):
        for keys, name in zip(J.rarest(J.shingles(text, 4), frequent, 85), ("larger", "smaller")):
            want += [(k, doc, doc + 3, name) for k in keys.view(np.int64).tolist()]
    assert sorted(rows) == sorted(want)


def test_components_settle_without_a_spare_round(spark, monkeypatch):
    from tidemark.llm import components as K
    rounds, stars = [], K._stars
    monkeypatch.setattr(K, "_stars", lambda edges, large: rounds.append(large) or stars(edges, large))
    found = lambda links: sorted(map(tuple, K.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found([(1, 2), (3, 1), (7, 9), (5, 5), (2, 1)]) == [(1, 1), (2, 1), (3, 1), (7, 7), (9, 7)] and not rounds
    assert found([]) == [] and not rounds
    assert found([(k, k + 1) for k in range(30)] + [(50, 49), (49, 52), (52, 51)]) == [(k, 0) for k in range(31)] + [(k, 49) for k in range(49, 53)]
    assert rounds and found([(2, 3), (1, 3)]) == [(1, 1), (2, 1), (3, 1)]
