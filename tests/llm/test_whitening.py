import math
import random
from fractions import Fraction

import numpy as np
import pytest

from adlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int, n long, component string, c int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", 3) for i, v in rows], SCHEMA)


def expected(rows):
    """Exact integers and numpy's own eigenvalues of the exact covariance."""
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in rows), default=0)
    x = [[math.floor(1024 * c) + 100000 for c in v] + [100000] * (dim - len(v)) for _, v in rows]
    n = len(x)
    s = [sum(r[d] for r in x) for d in range(dim)]
    mean = [Fraction(t, n) for t in s]
    v = np.array([[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(dim)] for i in range(dim)])
    deviation = [sum((n * r[d] - s[d]) ** 2 for d in range(dim)) for r in x]
    return rows, x, n, s, v, deviation


def vectors(rng, n, dim, rank=None):
    basis = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(rank or dim)]
    out = []
    for i in range(n):
        w = [rng.gauss(0, 2.0 / (k + 1)) for k in range(len(basis))]
        out.append((i, [sum(a * b[d] for a, b in zip(w, basis, strict=True)) for d in range(dim)]))
    return out


@pytest.mark.parametrize("seed,n,dim", [(1, 60, 12), (2, 200, 5), (3, 6, 9), (4, 2, 3), (5, 90, 1)])
def test_equals_a_direct_computation(spark, seed, n, dim):
    rng = random.Random(seed)
    rows = vectors(rng, n, dim)
    rows += [(1000, None), (1001, [None] * dim), (1002, [math.nan] * dim), (1003, [math.inf] + [0.0] * (dim - 1)),
             (None, rows[0][1]), (1, rows[1][1])]
    kept, x, total, s, v, deviation = expected(rows)
    out = W.whiten(frame(spark, rows).repartition(3)).collect()
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1], vecs[:, ::-1]
    few = min(8, int((values > 1e-9 * values[0]).sum()))
    assert len(out) == few * len(kept) and {r.n for r in out} == {total}
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.component, r.deviation) for r in out) == sorted(
        (-1 if i is None else i, k + 1, d) for (i, _), d in zip(kept, deviation, strict=True) for k in range(few))
    for r in out:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-8
    for k in range(few):
        u = vecs[:, k]
        want = {i: float((np.array(r, float) - np.array(s) / total) @ u) / math.sqrt(values[k]) for (i, _), r in zip(kept, x, strict=True)}
        got = {r.vec_id: r.whitened for r in out if r.component == k + 1}
        sign = np.sign(sum(want[i] * got[i] for i in want))
        assert all(got[i] == pytest.approx(sign * want[i], abs=1e-6) for i in want)


def test_partitions_agree(spark):
    rows = vectors(random.Random(7), 300, 10)
    a, b = (sorted((r.vec_id, r.component, r.n, r.deviation, r.explained, r.whitened) for r in W.whiten(
        frame(spark, rows).repartition(k)).collect()) for k in (1, 7))
    assert [r[:5] for r in a] == [r[:5] for r in b]  # exact, as the sums are
    assert [r[5] for r in a] == pytest.approx([r[5] for r in b], abs=1e-12)


def test_small_variance_beside_a_large_one_keeps_its_digits(spark):
    """Columns of very different size: what the triangular factor and Jacobi are for."""
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 3000.0), rng.gauss(0, 3.0), rng.gauss(0, 0.01)]) for i in range(400)]
    _, _, _, _, v, _ = expected(rows)
    got = {r.component: r.explained for r in W.whiten(frame(spark, rows)).collect()}
    want = np.linalg.svd(np.linalg.cholesky(v), compute_uv=False) ** 2 / np.trace(v)
    assert [got[k] for k in (1, 2, 3)] == pytest.approx(list(want), rel=1e-6)


def test_factor_and_rotations():
    rng = np.random.default_rng(9)
    for d, r in [(1, 1), (2, 2), (7, 7), (12, 5), (33, 33)]:
        g = rng.normal(size=(d, r)) * rng.uniform(0.01, 10, r)
        v = g @ g.T
        low, order = W.pivoted_cholesky(v)
        assert low.shape[1] == r and np.allclose(np.triu(low[:r], 1), 0) and (np.diff(np.diag(low)) <= 1e-9).all()
        assert np.allclose(low @ low.T, v[np.ix_(order, order)], atol=1e-9 * np.trace(v))
        a = W.jacobi(low)
        cos = a.T @ a / np.sqrt(np.outer((a * a).sum(0), (a * a).sum(0)))
        assert np.abs(cos - np.eye(r)).max() < 1e-12 and np.allclose(a @ a.T, low @ low.T, atol=1e-9 * np.trace(v))


def test_rank_ties_repeats_and_padding(spark):
    square = [(i, [float(a), float(b)]) for i, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]  # equal eigenvalues
    out = W.whiten(frame(spark, square * 3)).collect()
    assert len(out) == 24 and all(r.explained == pytest.approx(0.5) and abs(r.whitened) < 1.5 for r in out)
    assert out[0].identity_error < 1e-12
    flat = W.whiten(frame(spark, vectors(random.Random(3), 50, 6, rank=1))).collect()
    assert {r.component for r in flat} >= {1}
    assert W.whiten(frame(spark, [(1, [0.5, 0.5])] * 4)).collect() == []  # no variance
    assert W.whiten(frame(spark, [(1, [])])).collect() == []
    padded = W.whiten(frame(spark, [(1, [2.0]), (2, [0.0, 1.0]), (3, [])])).collect()
    same = W.whiten(frame(spark, [(1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])])).collect()
    assert sorted(padded) == sorted(same) and len(padded) == 6


def test_empty_table_and_nothing_usable(spark):
    for rows in ([], [(1, None), (2, [math.nan])]):
        df = W.whiten(frame(spark, rows))
        assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert df.collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * (-1) ** i + i, float(i)]) for i in range(6)] + [(90, [1e300, 0.0])]
    kept, _, n, _, v, deviation = expected(rows[:-1])
    out = W.whiten(frame(spark, rows)).collect()
    assert {r.n for r in out} == {n}
    assert {r.vec_id: r.deviation for r in out} == {i: d if d < 2 ** 63 else None for (i, _), d in zip(kept, deviation, strict=True)}
    # sums are exact as well where products pass 64 bits
    assert out[0].explained == pytest.approx(np.linalg.eigvalsh(v)[-1] / np.trace(v), rel=1e-9)
