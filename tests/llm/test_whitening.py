import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adgrove.llm import whitening
from adgrove.llm.whitening import Factor, Moments, leading, products, whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "n string, vec_id bigint, embedding array<double>, component int"


def covariance(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("seed", range(5))
def test_inertia_and_solutions(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((30, 30))
    a += a.T
    f = Factor(a, 1e-300)
    assert f.positive() == (np.linalg.eigvalsh(a) > 0).sum()
    b = rng.standard_normal(30)
    assert np.allclose(a @ f.solve(b), b)
    assert Factor(np.zeros((4, 4)), 1e-9).positive() == 4  # a vanishing pivot counts as a small positive one
    assert Factor(np.array([[0.0, 1], [1, 0]]), 1e-300).positive() == 1


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1, .5], [1e6, 1, 1e-3, 1e-6, 0, 0], [5, 5, 5, 5, 5], [3, 3, 2, 2, 2, 1], [4],
    [1 + 1e-9, 1, 1 - 1e-9, .5], [1 + 1e-15, 1, .25], list(np.linspace(1, 2, 60)),
])
def test_leading_eigenvalues(values):
    v = covariance(np.random.default_rng(len(values)), values)
    found = leading(v, 8)
    want = [w for w in sorted(np.linalg.eigvalsh(v))[::-1] if w > 4 * len(v) * np.finfo(float).eps * np.trace(v)][:8]
    scale = np.trace(v)
    assert len(found.values) == len(want) and found.certified.all()
    assert np.abs(found.values - want).max() < 1e-13 * scale
    assert np.abs(found.vectors @ found.vectors.T - np.eye(len(want))).max() < 1e-14
    assert np.linalg.norm(v @ found.vectors.T - found.vectors.T * found.values, axis=0).max() < 1e-13 * scale


def test_no_variance_has_no_component():
    assert len(leading(np.zeros((3, 3))).values) == 0


@given(st.lists(st.lists(st.integers(-(1 << 61), 1 << 61), min_size=3, max_size=3), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_moments_are_exact(rows):
    m, x = Moments(3), np.array(rows, np.int64)
    m.add(x[:2])
    m.add(x[-1:])
    exact = np.array([*rows[:2], rows[-1]], object)
    assert m.n == len(exact) and (m.sums == exact.sum(0)).all() and (m.products == exact.T @ exact).all()
    small = x >> 40
    assert (products(small) == small.astype(object).T @ small.astype(object)).all()


def check(rows, got, scale=1024, shift=100_000, most=8):
    """Whole result against exact integers and numpy's eigenvectors; rows: (id, vector) of one length without gaps."""
    x = [[int(np.floor(scale * c)) + shift for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(dim)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    trace, values, vectors = values.sum(), values[::-1][:most], vectors[:, ::-1][:, :most]
    got = sorted(got, key=lambda r: (r.component, r.vec_id))
    assert len(got) == n * min(most, dim)
    for k in range(min(most, dim)):
        part = got[k * n: k * n + n]
        assert [r.vec_id for r in part] == [i for i, _ in rows] and {r.component for r in part} == {k + 1}
        assert [int(r.deviation) for r in part] == deviation and {r.n for r in part} == {n}
        assert np.allclose([r.explained for r in part], values[k] / trace if trace else 0, rtol=1e-4, atol=1e-12)
        if part[0].whitened is not None:
            want = centred @ vectors[:, k] / np.sqrt(values[k])
            mine = np.array([r.whitened for r in part])
            assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
    assert all(r.identity_error <= 1e-4 for r in got)


def test_whitening_of_random_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(12) * np.arange(1, 13)).tolist()) for i in range(200)]
    given = [("x", i, v, 5) for i, v in rows] + [
        ("x", 900, None, 1), ("x", 901, [None, *[1.0] * 11], 1), ("x", 902, [float("nan")] * 12, 1),
        ("x", 903, [float("-inf")] * 12, 1), ("x", 904, [], 1),
    ]
    out = whiten(spark.createDataFrame(given, SCHEMA).repartition(3))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, out.collect())


def test_lengths_repeated_rows_and_missing_variance(spark):
    two = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [1.0, 5.0]), (7, [2.0, 0.0])]
    flat = [(i, [1.0, 2.0, 3.0]) for i in range(4)]
    rows = [("", i, v, 0) for i, v in two + flat] + [("", None, [1.0, 2.0, 3.0, 4.0], 0)]
    got = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    check(two, [r for r in got if r.n == 4 and r.vec_id is not None and (r.explained > 0 or r.component > 3)])
    still = [r for r in got if r.whitened is None]
    assert len(still) == 4 * 3 + 4 and {float(r.explained) for r in still} == {0.0} and {r.identity_error for r in still} == {0.0}
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_entries(spark):
    rows = [(i, [3e5 * i, -4e8 + i, 1e300 if i == 3 else 7.0 * i * i]) for i in range(9)]
    got = whiten(spark.createDataFrame([("", i, v, 0) for i, v in rows], SCHEMA), most=3).collect()
    held = [(i, [min(c, float(whitening.LARGEST) / 1024) for c in v]) for i, v in rows]
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in held]
    sums = [sum(r[k] for r in x) for k in range(3)]
    want = {i: sum((9 * c - s) ** 2 for c, s in zip(r, sums)) for (i, _), r in zip(held, x)}
    assert {r.vec_id: r.deviation and int(r.deviation) for r in got} == {i: w if w < 10 ** 38 else None for i, w in want.items()}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_query(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in given
            if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(rows, whitening.query(spark, SF).collect())
