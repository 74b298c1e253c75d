"""Whitening against numpy's dense eigendecomposition, and its edge cases."""

import math

import numpy as np
import pytest

from voltframe.llm import whitening


def dense(vectors):
    x = np.floor(1024 * np.array(vectors, np.float64)) + 100_000
    middle = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(middle.T @ middle / len(x))
    return x, middle, values[::-1], vectors[:, ::-1]


def test_components_match_a_dense_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((400, 40)) * np.linspace(1.0, 0.2, 40)).astype(np.float32)
    vectors[100:200] = vectors[100]
    unfit = [None, [1.0] * 39 + [None], [math.nan] + [0.0] * 39, [math.inf] + [0.0] * 39, [], [1.0, 2.0]]
    rows = [(k, "a", v.tolist()) for k, v in enumerate(vectors)] + [(1000 + k, "b", v) for k, v in enumerate(unfit)]
    df = spark.createDataFrame(rows, "vec_id long, row string, embedding array<float>").repartition(5)
    got = whitening.components(df).collect()
    x, middle, values, axes = dense(vectors)
    assert len(got) == 400 * 8 and {r.n for r in got} == {400}
    by_id = {}
    for r in got:
        by_id.setdefault(r["row"]["vec_id"], {})[r.component] = r
    whole = x.astype(int).astype(object)
    deviations = ((400 * whole - whole.sum(axis=0)) ** 2).sum(axis=1)
    own = np.array([[by_id[k][c].whitened for c in range(1, 9)] for k in range(400)])
    want = middle @ axes[:, :8] / np.sqrt(values[:8])
    sign = np.sign((own * want).sum(axis=0))
    assert np.abs(own - want * sign).max() < 1e-9
    assert [int(by_id[k][1].deviation) for k in range(400)] == list(deviations)
    for c in range(8):
        assert by_id[0][c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-12)
    assert {r.identity_error for r in got}.pop() < 1e-12


@pytest.mark.parametrize("gap", [0.0, 0.02, 0.5])
def test_clustered_spectra_are_certified(gap):
    rng = np.random.default_rng(5)
    axes = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    values = np.sort(1 + gap * rng.random(120))[::-1]
    values[:3] = [50, 50, 9]
    whole = (axes * values) @ axes.T
    found, vectors, residual = whitening.subspace(lambda q: whole @ q, 120, values.sum(), 8)
    assert residual < whitening.ACCEPTED
    assert np.allclose(found, values[:8], rtol=1e-10)
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-12)


def test_few_rows_equal_rows_and_empty_tables(spark):
    shape = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(1, [0.0, 1.0, 2.0]), (None, [1.0, 1.0, 5.0]), (1, [0.0, 1.0, 2.0])], shape)
    got = whitening.components(few).collect()
    # Three rows on one line have one component.
    assert [r.component for r in got] == [1] * 3 and got[0].explained == pytest.approx(1)
    assert sorted(r.whitened for r in got)[0] in (pytest.approx(-math.sqrt(2)), pytest.approx(-math.sqrt(0.5)))
    for rows in ([], [(1, [2.0, 3.0])], [(k, [0.5, 0.25]) for k in range(4)], [(1, None)]):
        assert whitening.components(spark.createDataFrame(rows, shape)).count() == 0
    two = spark.createDataFrame([(k, [float(k % 3), float(k % 5)]) for k in range(15)], shape)
    assert whitening.components(two).count() == 30
    # Huge entries are held back, and what long sums cannot hold has its digits all the same.
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0])], shape)
    assert {int(r.deviation) for r in whitening.components(huge).collect()} == {(2 * 2**52) ** 2}


def test_partial_sums_in_two_levels(spark):
    df = spark.range(500).selectExpr("array(id, 2 * id) AS x").repartition(20)
    got = whitening.summed(df, "x", np.int64, lambda x: x.sum(axis=0), 20)
    old, whitening.DRIVER_PARTS = whitening.DRIVER_PARTS, 4
    try:
        assert (whitening.summed(df, "x", np.int64, lambda x: x.sum(axis=0), 20) == got).all()
    finally:
        whitening.DRIVER_PARTS = old
