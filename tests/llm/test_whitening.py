"""Whitening against exact fractions and known spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from lendgrade.llm import registry, whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int, component int, x string, id int"


def plain(rows, scale=256):
    """n, S, covariance and deviations in exact fractions."""
    xs = {i: tuple(math.floor(scale * c) for c in v) for i, v in rows}
    fit = sorted(set(xs.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    cov = [[sum((x[i] - Fraction(sums[i], n)) * (x[j] - Fraction(sums[j], n)) for x in fit) / n for j in range(d)] for i in range(d)]
    return xs, n, sums, cov, {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in xs.items()}


def test_whole_result_is_that_of_exact_fractions(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * np.array([3, 2, 1, 1, 0.5, 40]) + 7).tolist()) for i in range(80)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # copies fit once
    odd = [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] + [0.0] * 5), (304, [float("inf")] + [0.0] * 5), (305, [1.0, 2.0]), (306, [1e300] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, 9, "x", 3) for i, v in rows + odd] + [(None, rows[0][1], 1, 9, "x", 3), (0, rows[0][1], 1, 9, "x", 3)], SCHEMA)
    got = whitening.whiten(df).collect()
    xs, n, sums, cov, far = plain(rows)
    assert len(got) == 4 * (len(rows) + 2)
    value, vector = np.linalg.eigh(np.array(cov, dtype=np.float64))
    value, vector = value[::-1], vector[:, ::-1]
    for r in got:
        i = 0 if r.vec_id is None else r.vec_id
        k = r.component - 1
        want = np.array([c - s / n for c, s in zip(xs[i], sums)]) @ vector[:, k] / np.sqrt(value[k])
        assert r.n == n and r.deviation == far[i]
        assert np.isclose(abs(r.whitened), abs(want), rtol=1e-9, atol=1e-9)
        assert np.isclose(r.explained, value[k] / value.sum(), rtol=1e-12)
        assert 0 <= r.identity_error < 1e-9
    signs = {(r.component, np.sign(r.whitened) == np.sign(np.array([c - s / n for c, s in zip(xs[r.vec_id], sums)]) @ vector[:, r.component - 1])) for r in got if r.vec_id is not None}
    assert len(signs) == 4  # one sign a component


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(df).count() == 0
    one = spark.createDataFrame([(1, [0.5, 1.0], None, 0, "", 0), (2, [0.5, 1.0], None, 0, "", 0)], SCHEMA)
    got = whitening.whiten(one).collect()
    assert len(got) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in got)
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], None, 0, "", 0) for i in range(9)], SCHEMA)  # rank 1
    got = whitening.whiten(flat).collect()
    assert {r.component for r in got} == {1, 2, 3}
    assert all((r.whitened is not None) == (r.component == 1) for r in got)
    assert all(abs(r.explained - (r.component == 1)) < 1e-12 and r.identity_error < 1e-12 for r in got)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [2.0**40 + i, -(2.0**41) + 3 * i * i, 2.0**43 * (i % 3)]) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, 0, "", 0) for i, v in rows], SCHEMA)).collect()
    far = plain(rows)[4]
    assert all(r.deviation == far[r.vec_id] for r in got)
    assert all(r.identity_error < 1e-9 for r in got)
    z = np.array([[2**52, -(2**51)], [3, 2**50 + 1]])
    assert (whitening.gram(z) == z.astype(object).T @ z.astype(object)).all()


SPECTRA = {
    "apart": np.linspace(1, 2, 24),
    "close": np.concatenate([np.linspace(1, 2, 20), 1.5 + np.array([1e-9, 2e-9, 0, -1e-9])]),
    "equal": np.concatenate([np.ones(20), [2, 2, 2, 3]]),
    "steep": 10.0 ** -np.arange(24),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_refined_beyond_single_precision(name):
    d = 24
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(d, d)))[0].astype(whitening.WIDE)
    for _ in range(3):
        q = q + q @ (np.eye(d) - q.T @ q) / 2
    want = np.sort(SPECTRA[name])[::-1].astype(whitening.WIDE)
    a = (q * want) @ q.T
    a = (a + a.T) / 2
    first = np.linalg.eigh(a.astype(np.float32))[1]
    value, x = whitening.refine(a, first)
    assert np.abs(value - want).max() < 1e-15
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-15
    assert np.abs(a @ x - x * value).max() < 1e-15
    if name != "steep":  # what it began from
        assert np.abs(first.astype(float).T @ first.astype(float) - np.eye(d)).max() > 1e-8
    if name == "close":  # of the cluster, too, the vectors
        assert np.abs(np.abs(x.T @ q) - np.eye(d)).max() < 1e-8


def test_query_on_the_table(spark):
    got = registry.op13_embedding_whitening(spark, "/root/testdata/sf0.01")
    assert got.count() == 4 * 500
    assert dict(got.dtypes)["deviation"] == "bigint"
    assert got.agg({"identity_error": "max"}).first()[0] < 1e-9
