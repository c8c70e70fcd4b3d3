"""Whitening against a dense eigendecomposition, exact deviations, odd vectors."""

import numpy as np
import pytest

from wattline.llm import whiten


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<double>, whitened double, n int")


def dense(x, k):
    y = x - x.mean(0)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return values[::-1][:k], vectors[:, ::-1][:, :k]


def test_against_dense(spark):
    rng = np.random.default_rng(1)
    c = rng.standard_normal((400, 48)) * np.linspace(3, 0.5, 48)
    got = whiten.whiten(frame(spark, [(i, v.tolist()) for i, v in enumerate(c)]).repartition(5), 12).toPandas()
    x = np.floor(64 * c).astype(int) + 1_000_000
    assert len(got) == 400 * 12 and set(got.n) == {400} and got.identity_error.max() < 1e-10
    n, s = 400, x.sum(0)
    deviation = {i: sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for i, r in enumerate(x)}
    values, vectors = dense(x, 12)
    want = (x - x.mean(0)) @ vectors / np.sqrt(values)
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((table * want).sum(0))
    assert np.abs(table * sign - want).max() < 1e-8
    assert dict(zip(got.vec_id, got.deviation)) == deviation
    y = x - x.mean(0)
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values / np.trace(y.T @ y / n), rtol=1e-10)


def test_many_tasks_add_up(spark):
    """Beyond FAN tasks the partial sums are added in two steps."""
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 4)))]
    data = whiten.blocks(frame(spark, rows))
    s = whiten.sums(data)[4]
    one = whiten.gathered(data, (4, 4), lambda x: s.centred(x).T @ s.centred(x))
    spread = whiten.gathered(data.repartition(90), (4, 4), lambda x: s.centred(x).T @ s.centred(x))
    assert np.allclose(one, spread)


def test_filter_is_used_and_certified():
    """Flat spectra need several cycles; the wanted pairs come out at rounding level in each."""
    for seed, top in ((1, 1.0), (2, 50.0)):
        rng = np.random.default_rng(seed)
        q = np.linalg.qr(rng.standard_normal((80, 80)))[0]
        w = np.concatenate([[top], np.sort(rng.uniform(0.8, 1.0, 79))[::-1]])
        a = q * w @ q.T
        f = whiten.principal(lambda v: a @ v, 80, 10, w.sum())
        assert f.passes > 20 and f.residual < 1e-12 * top
        assert np.allclose(f.values, np.sort(w)[::-1][:10], atol=1e-12 * top, rtol=0)


@pytest.mark.parametrize("rank", [1, 3])
def test_lost_rank(rank):
    rng = np.random.default_rng(3)
    b = rng.standard_normal((60, rank))
    f = whiten.principal(lambda v: b @ (b.T @ v), 60, 10, float((b * b).sum()))
    assert len(f.values) == rank


def test_odd_vectors(spark):
    """Null, short, empty, not finite, too large; repeated rows; null vec_id; one row of a length."""
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-3.0, 0.5]), (None, [0.0, 7.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [1e30, 0.0])]
    got = whiten.whiten(frame(spark, rows)).toPandas()
    assert got.vec_id.isna().sum() == 2 and sorted(got.vec_id.dropna()) == [1, 1, 1, 1, 2, 2] and set(got.n) == {4}
    assert got.columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_equal_and_empty(spark):
    assert whiten.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert whiten.whiten(frame(spark, [])).count() == 0


def test_exact_deviation_beyond_long():
    s = whiten.Sums(3, [0, 3 * 2 ** 39])
    x = np.array([[2 ** 39, 2 ** 39], [-2 ** 39, 2 ** 39], [0, 2 ** 39]])
    assert s.deviation(x) == [None, None, 0]
    assert whiten.Sums(3, [3, 4]).deviation(np.array([[1, 2]])) == [4]
