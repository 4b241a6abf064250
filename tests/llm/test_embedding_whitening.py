"""Whitening against numpy's eigenvectors and whole numbers of Python."""

from __future__ import annotations

import numpy as np
import pytest

from signal_lake.llm import catalog
from signal_lake.llm import embedding_whitening as W


def plain(vectors, components=W.COMPONENTS):
    """(n, deviations, eigenvalues falling, eigenvectors, centred vectors, trace)."""
    x = [[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x, strict=True)]
    away = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    deviation = [sum(c * c for c in v) for v in away]
    centred = np.array([[c / n for c in v] for v in away])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    return n, deviation, values[::-1][:components], axes[:, ::-1][:, :components], centred, np.trace(covariance)


def frame(spark, vectors):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")


def compare(rows, vectors):
    n, deviation, values, axes, centred, trace = plain(vectors)
    values = values[values > 1e-12 * values[0]]
    white = centred @ axes[:, : len(values)] / np.sqrt(values)
    got = np.zeros_like(white)
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
        assert r.identity_error < 1e-6
    assert len(rows) == white.size
    got *= np.sign((got * white).sum(axis=0))
    assert np.abs(got - white).max() < 1e-6


@pytest.mark.parametrize("shape", [(300, 8), (400, 64), (200, 100), (12, 20)])
def test_components_are_those_of_the_covariance(spark, shape):
    rng = np.random.default_rng(shape[0])
    vectors = (rng.standard_normal(shape) * np.linspace(0.5, 2, shape[1])).astype(np.float32)
    compare(W.whiten(frame(spark, vectors)).collect(), vectors)


def test_residuals_fall_until_certified(spark):
    rng = np.random.default_rng(7)
    matrix = rng.standard_normal((500, 90)) * np.linspace(1, 1.6, 90)
    matrix -= matrix.mean(axis=0)
    covariance = matrix.T @ matrix / 500
    calls = []

    def times(block):
        calls.append(block.shape)
        return covariance @ block

    values, axes, residuals = W.leading_components(times, 90)
    want = np.linalg.eigvalsh(covariance)[::-1][:32]
    assert np.allclose(values, want, rtol=1e-12) and np.abs(covariance @ axes - axes * values).max() < 1e-11
    assert residuals[0] > 1e-4 and min(residuals) < 1e-12 and len(residuals) > 1
    assert all(b < a for a, b in zip(residuals[:3], residuals[1:3], strict=False))
    assert len(calls) < 150


def test_flat_and_repeated_spectra():
    for covariance in (np.eye(70), np.diag([*[3.0] * 40, *[1.0] * 60]), np.diag([5.0, *[0.0] * 80])):
        values, axes, _ = W.leading_components(lambda block, c=covariance: c @ block, len(covariance))
        want = np.sort(np.diag(covariance))[::-1][:32]
        assert np.allclose(values, want[want > 0], rtol=1e-12)
        assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-12)


def test_centring_is_exact_beyond_64_bits():
    x = np.array([[(1 << 61) + 5, -7], [-(1 << 61), 9]])
    sums = [int(x[0, 0]) + int(x[1, 0]), 2]
    got = W.centred(x, 2, sums)
    assert got.tolist() == [[2 * int(x[0, 0]) - sums[0], -16], [2 * int(x[1, 0]) - sums[0], 16]]
    small = np.array([[3, 4], [5, 9]])
    assert W.centred(small, 2, [8, 13]).tolist() == [[-2, -5], [2, 5]]


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    fine = [[float(c) for c in v] for v in rng.standard_normal((30, 3)).astype(np.float32)]
    rows = [(i, v) for i, v in enumerate(fine)] + [(0, fine[0]), (None, fine[1])]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1e30, 0.0, 0.0]), (106, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, "clash") for i, v in rows + odd], "vec_id bigint, embedding array<float>, component string")
    got = W.whiten(table).collect()
    n, deviation, *_ = plain(fine + [fine[0], fine[1]])
    assert len(got) == 32 * 3 and {r.n for r in got} == {n}
    assert sorted({r.deviation for r in got}) == sorted(set(deviation)) and sum(r.vec_id is None for r in got) == 3


def test_tables_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id bigint, embedding array<float>")
    assert W.whiten(same).collect() == []
    empty = W.whiten(same.limit(0))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    large = spark.createDataFrame([(1, [2.0**40, 0.0]), (2, [-(2.0**40), 0.0])], "vec_id bigint, embedding array<double>")
    rows = W.whiten(large).collect()
    assert [r.deviation for r in rows] == [None, None] and sorted(round(r.whitened, 9) for r in rows) == [-1.0, 1.0]


def test_query(spark, small_sf):
    rows = catalog.QUERIES["op12_embedding_whitening"](spark, small_sf).collect()
    table = spark.read.parquet(f"{small_sf}/embeddings.parquet").orderBy("vec_id").collect()
    number = {r.vec_id: i for i, r in enumerate(table)}
    from pyspark.sql import Row

    compare([Row(**{**r.asDict(), "vec_id": number[r.vec_id]}) for r in rows], [r.embedding for r in table])
