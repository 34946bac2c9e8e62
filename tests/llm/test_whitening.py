"""Operator 12 against a dense eigendecomposition."""

import numpy as np
import pytest

from ballotlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, d int, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "c", 3, 4)
                                  for i, v in rows], SCHEMA)


def dense(v, k):
    x = np.floor(1024 * np.asarray(v, np.float32).astype(float)) + 100000
    c = x - x.mean(axis=0)
    value, basis = np.linalg.eigh(c.T @ c / len(c))
    value, basis = value[::-1][:k], basis[:, ::-1][:, :k]
    n, ints = len(x), x.astype(int)
    dev = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, ints.sum(axis=0))) for row in ints]
    return c @ basis / np.sqrt(value), value / np.trace(c.T @ c / len(c)), dev


@pytest.mark.parametrize("d,k", [(5, 8), (40, 8), (70, 3)])
def test_like_dense(spark, d, k):
    rng = np.random.default_rng(d)
    v = (rng.standard_normal((300, d)) * np.linspace(1, 0.2, d)).astype(np.float32)
    v[7] = v[8]
    rows = [(i, r.tolist()) for i, r in enumerate(v)]
    rows += [(900, None), (901, []), (902, [None] * d), (903, [float("nan")] + [0.0] * (d - 1)), (904, [float("inf")] * d)]
    out = whitening.whiten(frame(spark, rows), k=k).toPandas().sort_values(["vec_id", "component"])
    white, share, dev = dense(v, k)
    m = min(k, d)
    assert len(out) == 300 * m and set(out["n"]) == {300}
    got = out["whitened"].to_numpy().reshape(300, m)
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < 1e-9
    assert np.abs(out["explained"].to_numpy()[:m] / share - 1).max() < 1e-10
    assert out["deviation"].to_numpy().reshape(300, m)[:, 0].tolist() == dev
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9


def test_null_and_repeated_ids(spark):
    rng = np.random.default_rng(1)
    rows = [(None, rng.standard_normal(4)), (None, rng.standard_normal(4)), (5, rng.standard_normal(4)), (5, [1, 2, 3, 4])]
    out = whitening.whiten(frame(spark, rows), k=2).toPandas()
    assert len(out) == 8 and out["vec_id"].isna().sum() == 4 and set(out["n"]) == {4}


def test_without_variance(spark):
    assert whitening.whiten(frame(spark, [(i, [1, 2, 3]) for i in range(9)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0
    # Two distinct vectors: one direction only.
    out = whitening.whiten(frame(spark, [(1, [0, 0, 0]), (2, [1, 1, 1]), (3, [1, 1, 1])])).toPandas()
    assert set(out["component"]) == {1} and abs(out["explained"].iloc[0] - 1) < 1e-12


def test_different_lengths(spark):
    with pytest.raises(ValueError, match="lengths"):
        whitening.whiten(frame(spark, [(1, [1, 2]), (2, [1, 2, 3])]))


def test_deviation_beyond_long(spark):
    out = whitening.whiten(frame(spark, [(1, [1e8, 0]), (2, [-1e8, 1]), (3, [0, 0])]), k=1).toPandas().set_index("vec_id")
    assert np.isnan(out.loc[1, "deviation"]) and out.loc[3, "deviation"] >= 0


def test_search_is_certified():
    """Equal and close eigenvalues, a null space, and a filter that is needed."""
    rng = np.random.default_rng(3)
    for spectrum in ([5, 5, 5, 5, 4.99] + [4.9] * 95, [1] * 3 + [0] * 97, np.linspace(1, 0.9, 100), 0.5 ** np.arange(100)):
        q = np.linalg.qr(rng.standard_normal((100, 100)))[0]
        v = (q * np.asarray(spectrum, float)) @ q.T
        value, basis, residual = whitening.eigenpairs(lambda b: v @ b, 100, 4, float(np.trace(v)), extra=8)
        assert np.abs(value - np.sort(spectrum)[::-1][:4]).max() < 1e-11
        assert np.abs(v @ basis - basis * value).max() < 1e-10 and residual < 1e-10


def test_too_few_rounds():
    v = np.diag(np.linspace(1, 0.999, 100))
    with pytest.raises(ArithmeticError, match="certified"):
        whitening.eigenpairs(lambda b: v @ b, 100, 4, float(np.trace(v)), extra=2, rounds=2)
