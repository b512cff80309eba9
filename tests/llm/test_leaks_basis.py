"""The projection's basis holds no direction that is a rounding error alone."""

import numpy as np

from tidemark.llm.leaks import SIZE, _basis, fit_projection, terms


def test_basis_of_few_directions():
    rng = np.random.default_rng(1)
    z = (rng.normal(size=(5000, 3)) @ rng.normal(size=(3, 40))).astype(np.float32)
    q = _basis(z)
    assert q.shape == (5000, 3) and np.allclose(q.T @ q, np.eye(3), atol=1e-4)
    assert np.allclose(q @ (q.T @ z), z, atol=1e-3 * np.abs(z).max())


def test_projection_of_one_passage(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    projection = fit_projection(none, [terms("one two three four five six seven eight")])
    assert projection.shape == (SIZE, 1) and np.isfinite(projection).all()
    assert (projection != 0).sum() == 8
