from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import whitening as W
from tests.conftest import SF_CHECK


def random_symmetric(rng, n, values):
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    return (q * values) @ q.T


@pytest.mark.parametrize("n, values", [
    (1, [3.0]), (2, [5.0, 1.0]), (6, [9, 9, 9, 2, 1, 0.5]), (30, np.linspace(1, 2, 30)), (64, np.ones(64)),
    (64, [1e9, 1e3, 1, 1e-3] + [1e-6] * 60), (40, [4, 3, 2] + [0] * 37), (50, [5, 4, 3, 2.0000001, 2] + [1] * 45)])
def test_components_against_a_direct_solver(n, values):
    matrix = random_symmetric(np.random.default_rng(n), n, np.array(values, float))
    matrix = (matrix + matrix.T) / 2
    got, vectors = W.largest_components(matrix, 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    want = want[want > W.NO_VARIANCE * np.trace(matrix)]
    assert len(got) == len(want)
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-13 * max(values))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-13)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-12 * max(values)


def test_inertia_counts_every_eigenvalue():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 20):
        matrix = random_symmetric(rng, n, rng.standard_normal(n) * 10)
        form, values = W.tridiagonal((matrix + matrix.T) / 2), np.linalg.eigvalsh(matrix)
        for shift in rng.standard_normal(20) * 10:
            assert W.above(form, shift) == (values > shift).sum()


def test_contour_projection_keeps_the_interval_only():
    matrix = np.diag([10.0, 9.0, 1.0, 0.5])
    out = W.projected(matrix, np.eye(4), 8.0, 11.0)
    np.testing.assert_allclose(np.diag(out), [1, 1, 0, 0], atol=1e-4)


def brute(vectors):
    """Contract columns by exact fractions and a direct solver, of vectors as lists."""
    x = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    centred = np.array([[float(Fraction(v[i] * n - sums[i], n)) for i in range(d)] for v in fit])
    cov = centred.T @ centred / n
    e, p = np.linalg.eigh(cov)
    e, p = e[::-1], p[:, ::-1]
    out = []
    for v in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        y = np.array([float(Fraction(a * n - s, n)) for a, s in zip(v, sums)])
        out.append((n, deviation, [abs(float(y @ p[:, c])) / np.sqrt(e[c]) for c in range(min(4, d))], e[:4] / e.sum()))
    return out


def test_every_vector_against_brute_force(llm):
    rows = llm.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    got = {}
    for r in W.whiten(rows).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    stored = rows.collect()
    assert len(got) == len(stored)
    for r, (n, deviation, whitened, explained) in zip(stored, brute([r.embedding for r in stored])):
        own = got[r.vec_id]
        assert sorted(own) == [1, 2, 3, 4]
        for c in range(4):
            assert (own[c + 1].n, own[c + 1].deviation) == (n, deviation)
            assert abs(own[c + 1].whitened) == pytest.approx(whitened[c], abs=1e-8)
            assert own[c + 1].explained == pytest.approx(explained[c], rel=1e-10)
            assert own[c + 1].identity_error < 1e-9


def test_odd_vectors(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.0]), (1, [0.5, -0.0]), (None, [0.25, 1.0]), (2, None), (3, []), (4, [None, 1.0]), (5, [nan, 1.0]),
            (6, [1.0, inf]), (7, [1.0, -inf]), (8, [1.0, 2.0, 3.0]), (9, [0.501, 0.001]), (10, [-3.0, 2.0])]
    table = llm.createDataFrame([(*r, 1, 2, "a") for r in rows], "vec_id int, embedding array<float>, x int, n int, id string")
    got = W.whiten(table).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted(
        (i, c) for i in ("1", "1", "None", "9", "10") for c in (1, 2))
    assert {r.n for r in got} == {3}  # -0.0 and 0.501 quantise to what is there already
    assert W.whiten(table.limit(0)).count() == 0
    assert W.whiten(table.where("vec_id = 1")).count() == 0  # no variance


def test_far_values_stay_exact(llm):
    far = [[3.0e7, 1.0], [3.0e7 + 4, 2.0], [3.0e7 + 8, 9.0], [-3.0e7, 4.0]]
    for scale in (1.0, 2.0 ** 25):
        table = llm.createDataFrame([(i, [c * scale for c in v]) for i, v in enumerate(far)], "vec_id int, embedding array<double>")
        got = {(r.vec_id, r.component): r for r in W.whiten(table).collect()}
        for i, (n, deviation, whitened, _) in enumerate(brute([[c * scale for c in v] for v in far])):
            assert got[i, 1].n == n
            assert got[i, 1].deviation == (deviation if deviation < 1 << 63 else None)
            assert abs(got[i, 1].whitened) == pytest.approx(whitened[0], rel=1e-9)


def test_result_does_not_depend_on_the_partitions(llm):
    rows = llm.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    a = {(r.vec_id, r.component): r.whitened for r in W.whiten(rows).collect()}
    b = {(r.vec_id, r.component): r.whitened for r in W.whiten(rows.repartition(7, F.rand(1))).collect()}
    assert a == b
