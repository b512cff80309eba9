"""Texts in no learned language go, short and clean ones stay."""

import random

import numpy as np
import pytest

from conftest import SF01
from tidemark.llm.langid import UNDETERMINED, fit, keep_identified, n_grams, score_limit
from tidemark.llm.queries import table

POLISH = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
          "i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności.")
FINNISH = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
           "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.")


@pytest.fixture(scope="module")
def model(spark):
    return fit(table(spark, SF01, "documents"))


def test_noise_and_other_languages_go(spark, model):
    rnd = random.Random(1)
    noise = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 10))) for _ in range(60)) for _ in range(20)]
    rows = [(k, t) for k, t in enumerate([POLISH, FINNISH, None, "12 34", *noise])]
    kept = {r.doc_id for r in keep_identified(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert 1 / len(model.languages) < model.least <= 0.6
    assert not kept & {0, 1, 2, 3} and len(kept) <= 2


def test_given_documents_and_short_texts_stay(spark, model):
    docs = table(spark, SF01, "documents")
    with_letters = docs.where(r"text rlike '\\p{L}'")
    assert keep_identified(with_letters, model).count() >= 0.998 * with_letters.count()
    short = [(1, "the house"), (2, "ok"), (3, "der Hund"), (4, "el perro"), (5, "le chat")]
    assert keep_identified(spark.createDataFrame(short, "doc_id long, text string"), model).count() == 5


def test_limit():
    assert score_limit(np.full(100, 0.99), 4) == 0.6 and score_limit(np.array([]), 4) == 1.25 / 4
    assert abs(score_limit(np.array([0.5] * 10 + [0.9] * 990), 4) - 0.45) < 1e-9 and score_limit(np.array([0.2] * 10), 4) == 1.25 / 4
    assert score_limit(np.array([1.0]), 1) == 0.6


def _plain_grams(text):
    """(n-gram of lower-cased letters with single blanks between runs) -> occurrences."""
    letters = "".join(c.lower() if c.isalpha() else " " for c in text)
    padded = " " + " ".join(letters.split()) + " " if letters.strip() else " "
    return {g: sum(padded[i:i + n] == g for i in range(len(padded) - n + 1)) for n in (1, 2, 3) for g in {padded[i:i + n] for i in range(len(padded) - n + 1)}}


def test_prediction_from_the_definition(spark, model):
    """N-grams, TF-IDF, softmax and temperature computed anew for given texts."""
    seen = {}
    for r in table(spark, SF01, "documents").where("text is not null").limit(40).collect():
        text = r.text[:300]
        own = _plain_grams(text)
        if not any(c.isalpha() for c in text):
            assert model.predict(text) == (UNDETERMINED, 0.0)
            continue
        at, counts = n_grams(text)
        assert counts.sum() == sum(own.values())
        seen.update(own)
        x = (1 + np.log(counts)) * model.idf[at]
        x = x / np.sqrt((x ** 2).sum())
        z = sum(v * model.weights[b].astype(float) for b, v in zip(at, x)) + model.weights[-1]
        p = np.exp(z / model.temperature) / np.exp(z / model.temperature).sum()
        lang, score = model.predict(text)
        assert lang == model.languages[int(p.argmax())] and abs(score - p.max()) < 1e-4
    assert len(seen) > 100
