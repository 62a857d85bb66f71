"""Embedding whitening against a plain eigen-decomposition, with ties, wide ranges, bad rows and long tables."""

import numpy as np
import pytest

from tallyframe.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, x int, id string, deviation double"


def rows_of(vectors):
    return [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "clash", 0.5) for i, v in enumerate(vectors)]


def check(spark, vectors, wanted=8):
    got = whitening.report(spark.createDataFrame(rows_of(vectors), SCHEMA).repartition(5), wanted).toPandas()
    fit = [(i, v) for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([np.float32(v) for _, v in fit], dtype=np.float64)) + 100_000
    n, mean = len(x), x.mean(0)
    cov = (x - mean).T @ (x - mean) / n
    values = np.linalg.eigvalsh(cov)[::-1]
    width = got.component.max()
    assert len(got) == n * width and set(got.n) == {n}
    exact = {i: int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, x.sum(0), strict=True))) for (i, _), r in zip(fit, x, strict=True)}
    assert {i: d for i, d in zip(got.vec_id, got.deviation, strict=True)} == exact
    share = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(share, values[:width] / np.trace(cov), rtol=1e-9)
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(w.T @ w / n - np.eye(width)).max() < 1e-8 and got.identity_error.max() < 1e-8
    # the projected rows span what the plain components span
    assert np.allclose((w * w).sum(1) if len(set(np.round(values, 6))) == len(values) else 0, 0 if len(set(np.round(values, 6))) != len(values) else (((x - mean) @ np.linalg.eigh(cov)[1][:, ::-1][:, :width]) ** 2 / values[:width]).sum(1))
    return got


def test_whitening_is_exact(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 1, (300, 24)) @ rng.normal(0, 0.3, (24, 24))
    vectors = [*base.astype(np.float32), None, [None] * 24, [float("nan")] * 24, [float("inf")] * 24, *base[:40].astype(np.float32)]
    check(spark, vectors)


def test_fewer_dimensions_and_equal_rows(spark):
    got = check(spark, [[1.0, 2.0, 3.0], [2.0, 2.0, 1.0], [0.5, 2.0, -1.0], [1.0, 2.0, 3.0]])
    assert got.component.max() == 2
    assert whitening.report(spark.createDataFrame(rows_of([[1.0, 2.0]] * 5), SCHEMA)).count() == 0
    assert whitening.report(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("values", [
    [5.0, 5.0, 5.0, 3.0, 1.0, 1.0], list(np.geomspace(1e6, 1e-3, 40)), [1.0 + k * 1e-9 for k in range(20)], [0.0, 0.0, 2.0, 7.0],
    list(np.linspace(1, 2, 64)),
])
def test_no_component_is_missed(values):
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    matrix = q @ np.diag(values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.components(matrix)
    want = np.array(sorted(v for v in values if v > max(values) * 1e-13)[::-1])
    assert len(found) == len(want) and np.allclose(found, want, rtol=1e-8, atol=1e-12 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-10 * max(values)


def test_inertia_counts():
    rng = np.random.default_rng(9)
    for d in (1, 2, 5, 30):
        m = rng.standard_normal((d, d))
        m = m + m.T
        for shift in rng.standard_normal(12) * 5:
            assert whitening.below(m, shift) == (np.linalg.eigvalsh(m) < shift).sum()


def test_large_whole_numbers_are_summed_exactly():
    x = np.array([[3 * 10**9, -7], [10**9, 5]], dtype=np.int64)
    assert (whitening._product_sums(x) == x.astype(object).T @ x.astype(object)).all()
