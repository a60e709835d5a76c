"""Whitening against plain numpy over all rows, and the refinement against known eigenvectors."""

import math

import numpy as np
import pytest

from corvane.llm import whitening
from corvane.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
HIGH = np.longdouble
VECTORS = "vec_id bigint, embedding array<double>, n int, component string, _vector string, whitened int"


def orthogonal(d, seed):
    """An orthogonal matrix in extended precision."""
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(HIGH)
    for _ in range(3):
        q = q @ (np.eye(d, dtype=HIGH) * HIGH(1.5) - (q.T @ q) / 2)
    return q


SPECTRA = {
    "apart": np.arange(1, 25), "clusters": np.r_[1 + 1e-9 * np.arange(6), 5, 5 + 1e-7, 5 + 3e-7, 9],
    "wide": 10.0 ** np.arange(-6, 6), "nested": np.r_[1, 1 + 1e-4, 1 + 1e-4 + 1e-9, 1 + 2e-9, 3],
    "equal": np.r_[2, 2, 2, 7, 7], "zero": np.r_[0, 0, 0, 1e-3, 1],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_refinement_reaches_extended_precision(name):
    values = np.sort(SPECTRA[name].astype(HIGH))[::-1]
    q = orthogonal(len(values), 5)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigenvectors(a)
    norm = float(np.abs(values).max())
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-16 * norm
    assert np.abs(found - values).max() < 1e-16 * norm
    for i, v in enumerate(values):
        gap = min(abs(float(v - w)) for j, w in enumerate(values) if j != i)
        if gap:
            assert 1 - abs(float(x[:, i] @ q[:, i])) < 1e-12
            assert np.abs(x[:, i] * np.sign(x[:, i] @ q[:, i]) - q[:, i]).max() < max(1e-15, 1e-16 * norm / gap)


def brute(rows, components=8):
    """vec_id -> (n, deviation, whitened up to sign), shares of variance; all from one array."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    d = max((sum(len(v) == k for _, v in rows), k) for k in {len(v) for _, v in rows})[1]
    rows = [(i, v) for i, v in rows if len(v) == d]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    y = np.array([[HIGH(n * c - s) / n for c, s in zip(v, sums)] for v in x], HIGH)
    v = (y.T @ y / n).astype(float)
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:components], w[:, ::-1][:, :components]
    return [i for i, _ in rows], n, deviations, (y.astype(float) @ w) / np.sqrt(e), e / np.trace(v)


def agrees(got, rows):
    ids, n, deviations, white, shares = brute(rows)
    k = white.shape[1]
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9
    table = {(r.vec_id, r.component): r for r in got}
    for c in range(k):
        mine = np.array([table[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine * sign - white[:, c]).max() < 1e-8
        assert all(abs(table[i, c + 1].explained - shares[c]) <= 1e-9 * shares[c] for i in ids)
        assert [table[i, c + 1].deviation for i in ids] == deviations


def test_query_equals_brute_force(spark):
    from corvane.llm.common import table

    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    agrees(QUERIES["op13_embedding_whitening"](spark, SF).collect(), rows)


def test_edge_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in draw.normal(size=10) * np.arange(1, 11)]) for i in range(200)]
    rows += [(900, None), (901, []), (902, [None] + [1.0] * 9), (903, [math.nan] * 10), (904, [math.inf] * 10),
             (905, [1.0] * 3), (906, rows[3][1]), (907, [0.0] * 10), (908, [-50.0] * 10)]
    df = spark.createDataFrame([(i, v, 1, "c", "v", 2) for i, v in rows], VECTORS).repartition(70)
    agrees(whitening.whitened_rows(spark, df).collect(), rows)
    assert whitening.covariance(whitening.usable(df.filter("vec_id < 200"), "embedding"), 200, [0] * 10).shape == (10, 10)


def test_tables_without_variance(spark):
    def count(rows):
        return whitening.whitened_rows(spark, spark.createDataFrame([(i, v, 1, "c", "v", 2) for i, v in rows], VECTORS)).count()

    assert count([]) == 0
    assert count([(1, None), (2, [])]) == 0
    assert count([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == 0
    assert count([(1, [1.0, 2.0]), (2, [1.0, 3.0]), (None, [1.0, 4.0]), (2, [1.0, 3.0])]) == 4
    assert count([(1, [1e300, 2.0]), (2, [-1e300, 3.0])]) > 0


def test_deviation_beyond_a_long():
    x = np.array([[1, 5], [2**61, 5]])
    n, sums = 2, [2**61 + 1, 10]
    assert whitening._deviations(x, n, sums) == [None, None]
    assert whitening._deviations(x[:1], 1, [1, 5]) == [0]
    near = np.array([[0], [2**31]])
    assert whitening._deviations(near, 2, [2**31]) == [2**62, 2**62]
