"""Whitening against exact sums and NumPy's eigenvectors."""

import math

import numpy as np
import pytest

from loomwork.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, most=4):
    """rows: (vec_id, vector); the same in plain Python and NumPy."""
    usable = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in usable})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(dims)]
    centred = np.array([[n * x[j] - sums[j] for j in range(dims)] for x in fit], dtype=np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(most, int((values > 1e-12 * values[0]).sum()))
    out = []
    for i, x in usable:
        d = np.array([n * a - s for a, s in zip(x, sums)], dtype=np.float64) / n
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(kept):
            out.append((i, k + 1, n, exact, d @ vectors[:, k] / math.sqrt(values[k]), values[k] / values.sum()))
    return out


def compare(found, expected):
    found = sorted((tuple(r) for r in found), key=lambda r: (str(r[0]), r[1], r[3]))
    expected = sorted(expected, key=lambda r: (str(r[0]), r[1], r[3]))
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    for k in {r[1] for r in expected}:
        a = np.array([r[4] for r in found if r[1] == k])
        b = np.array([r[4] for r in expected if r[1] == k])
        assert np.abs(a - b).max() < 1e-8 or np.abs(a + b).max() < 1e-8
    assert np.allclose([r[5] for r in found], [r[5] for r in expected], rtol=1e-9)
    assert all(r[6] < 1e-9 for r in found)


def test_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    found = whitening.whiten(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    compare(found.collect(), brute([tuple(r) for r in rows]))


def test_nulls_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.normal(size=5).astype(np.float32).tolist(), 1) for i in range(60)]
    data += [(100 + i, data[0][1], 1) for i in range(50)]
    data += [(7, data[7][1], 2), (None, data[3][1], 2), (200, None, 1), (201, [], 1)]
    data += [(202, [None, 1.0, 1.0, 1.0, 1.0], 1), (203, [float("nan")] * 5, 1), (204, [float("inf")] * 5, 1)]
    df = spark.createDataFrame([(*r, 1) for r in data], SCHEMA + ", n int").repartition(6)
    found = whitening.whiten(df)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(found.collect(), brute([r[:2] for r in data]))
    # vectors of a less frequent length have no place in the others' space
    other = spark.createDataFrame([(300, [1.0, 2.0], 1), (301, [3.0, 2.0], 1)], SCHEMA)
    compare(whitening.whiten(df.drop("n").unionByName(other)).collect(), brute([r[:2] for r in data]))


@pytest.mark.parametrize("kind", ["fewer rows than dimensions", "constant dimension", "repeated dimension", "far apart"])
def test_directions_without_variance(spark, kind):
    rng = np.random.default_rng(4)
    made = rng.normal(size=(3 if kind.startswith("fewer") else 40, 6))
    if kind == "constant dimension":
        made[:, 2] = 5.0
    if kind == "repeated dimension":
        made[:, 1] = made[:, 0]
    if kind == "far apart":
        made[:, 0] *= 30000
        made[:, 1] = made[:, 0] + made[:, 1] / 100
    data = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(made)]
    compare(whitening.whiten(spark.createDataFrame(data, SCHEMA)).collect(), brute([r[:2] for r in data]))


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(same.where("false")).collect() == []


def test_exact_deviation():
    rows = np.array([[1 << 20, -5], [3, 4], [1 << 30, 0]])
    exact = [sum((7 * x - s) ** 2 for x, s in zip(r, [2, 9])) for r in rows.tolist()]
    assert whitening.deviations(rows[:2], 7, [2, 9]) == exact[:2]
    assert whitening.deviations(rows, 7, [2, 9]) == [*exact[:2], None]
    assert exact[2] >= 1 << 63


def test_triangular_solve_and_orthonormal_columns():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(50, 6))
    r = np.linalg.cholesky(rows.T @ rows).T
    q = whitening.triangular_solve(rows, r)
    assert np.allclose(q @ r, rows) and np.allclose(q.T @ q, np.eye(6))
