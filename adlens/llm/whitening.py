"""Embedding whitening from a pivoted Cholesky factor and one-sided Jacobi.

Entries become integers, x = floor(1024 * c) + 100000. Two passes over the
rows give exact sums: of x per dimension, then of the products of x less its
rounded mean. Both are whole numbers added up without rounding, so the
covariance (over all rows, divisor n, centred) is exact before it becomes
double, whatever the partitions. Tasks hand on one sum per pair of dimensions,
never rows.

On the driver, with matrices of the dimension alone: the covariance is
factored with complete pivoting, P'VP = L L', and the columns of L are rotated
in pairs until they are orthogonal (``jacobi``). Their squared norms are the
eigenvalues, the columns over their norms the components. A third pass whitens
the rows, a fourth sums up the covariance of the whitened values.

Defined results: rows whose vector is null or holds null or non-finite entries
or entries whose x is no long take no part; null ids stay; repeated rows count
each; a shorter vector is as if padded with entries 0 (an empty one too, where
any vector has entries); components are those with an eigenvalue above
rounding, ``top`` at most, so equal rows, or a single one, give no result rows;
a deviation beyond 64 bits is null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
TOP = 8
SWEEPS = 60
LIMIT = 2 ** 62  # int64 sums stay below this, others are Python's integers
WIDEST = 2.0 ** 52  # entries from here on leave no room for x as a long


def usable(embedding: str | Column) -> Column:
    x = F.col(embedding) if isinstance(embedding, str) else embedding
    return x.isNotNull() & F.forall(x, lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v.cast("double")) < WIDEST), F.lit(False)))


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(1024 * c) of vectors padded to ``dim`` entries, as int64 (x less its shift)."""
    out = np.zeros((len(column), dim), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[np.arange(dim) < sizes[:, None]] = np.floor(SCALE * flat).astype(np.int64)
    return out


def _slices(batches: Iterator[pa.RecordBatch], dim: int, column: str = "c") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, (1 << 20) // max(dim, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            some = batch.slice(at, rows)
            yield some, integers(some.column(column), dim)


def _sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """n and the exact sums of x per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for _, x in _slices(batches, dim):
            n += len(x)
            exact = int(np.abs(x).max(initial=0)) * len(x) < LIMIT
            total += (x if exact else x.astype(object)).sum(0)
        yield _cells(np.arange(dim + 1), [n, *total])

    got = _added(rows.mapInArrow(add, "cell long, hi long, lo long"))
    return got.get(0, 0), [got.get(i + 1, 0) + SHIFT * got.get(0, 0) for i in range(dim)]


def _cells(cells, values) -> pa.RecordBatch:
    """Exact integers as hi * 2**40 + lo, whose parts can be summed as longs in any number of tasks."""
    values = [int(v) for v in values]
    return pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int64()), pa.array([v >> 40 for v in values], pa.decimal128(38, 0)).cast(pa.int64()),
         pa.array([v & (2 ** 40 - 1) for v in values], pa.int64())], names=["cell", "hi", "lo"])


def _added(parts: DataFrame) -> dict[int, int]:
    """The sum of each cell; as many cells as pairs of dimensions at most."""
    d = lambda c: F.sum(F.col(c).cast("decimal(19,0)")).cast("string").alias(c)
    return {r.cell: (int(r.hi) << 40) + int(r.lo) for r in parts.groupBy("cell").agg(d("hi"), d("lo")).toLocalIterator()}


def _products(rows: DataFrame, dim: int, centre: np.ndarray) -> dict[int, int]:
    """Exact sums of y_i * y_j for i <= j, where y = x less the rounded mean."""
    upper = np.triu_indices(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object)
        for _, x in _slices(batches, dim):
            if np.abs(x).max(initial=0) < 2 ** 61:
                y = x - centre
                most = int(np.abs(y).max(initial=0))
                if most * most * len(y) < 2 ** 53:  # whole numbers that doubles hold
                    total += np.rint(y.T.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
                    continue
            y = x.astype(object) - centre
            total += y.T @ y
        yield _cells(upper[0] * dim + upper[1], total[upper])

    return _added(rows.mapInArrow(add, "cell long, hi long, lo long"))


@dataclass(frozen=True)
class Whitener:
    n: int
    sums: tuple[int, ...]      # S per dimension, of x
    values: np.ndarray         # eigenvalues, falling
    vectors: np.ndarray        # components as columns
    trace: float


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): L lower trapezoidal with v[order][:, order] = L L'; the largest
    remaining diagonal entry is taken each time, until what remains is rounding."""
    a, d = v.copy(), len(v)
    order, low = np.arange(d), np.zeros((d, d))
    least = np.finfo(float).eps * d * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            return low[:, :k], order
        for m in (a, low):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    return low, order


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated pairwise until all are orthogonal.

    Each round rotates disjoint pairs at once (a round-robin of the columns).
    """
    a = factor.copy()
    r = a.shape[1]
    seats = list(range(r + r % 2))
    eps = np.finfo(float).eps * max(1, len(a)) ** 0.5
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(i, j) for i, j in zip(seats[:half], seats[:half - 1:-1], strict=True) if max(i, j) < r]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            do = np.abs(xy) > eps * np.sqrt(xx * yy)
            if not do.any():
                continue
            turned = True
            zeta = np.where(do, (yy - xx) / np.where(do, 2 * xy, 1.0), 0.0)
            t = np.where(do, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a[:, i], a[:, j] = c * x - s * y, s * x + c * y
        if not turned:
            break
    return a


def covariance(n: int, centre_sums: list[int], products: dict[int, int], dim: int) -> tuple[np.ndarray, float]:
    """V and its trace, exact until each entry becomes double: (n * sum(y y') - sum(y) sum(y)') / n**2."""
    v = np.zeros((dim, dim))
    total = 0
    for i in range(dim):
        for j in range(i, dim):
            exact = n * products.get(i * dim + j, 0) - centre_sums[i] * centre_sums[j]
            v[i, j] = v[j, i] = exact / (n * n)
            total += exact if i == j else 0
    return v, total / (n * n)


def fit(rows: DataFrame) -> Whitener | None:
    """Components of all rows (``c``: usable vectors); None without any entry."""
    dim = rows.agg(F.max(F.size("c"))).first()[0] or 0
    if not dim:
        return None
    c = rows.select("c")
    n, sums = _sums(c, dim)
    shifted = [s - SHIFT * n for s in sums]
    centre = np.array([(2 * s + n) // (2 * n) for s in shifted], np.int64)
    products = _products(c, dim, centre)
    v, trace = covariance(n, [s - n * int(m) for s, m in zip(shifted, centre, strict=True)], products, dim)
    low, order = pivoted_cholesky(v)
    turned = jacobi(low)
    values = (turned * turned).sum(0)
    by = np.argsort(-values, kind="stable")
    by = by[values[by] > 0]
    vectors = np.zeros((dim, len(by)))
    vectors[order] = turned[:, by] / np.sqrt(values[by])
    for k in range(len(by)):  # one sign for all runs: the largest entry is positive
        vectors[:, k] *= np.sign(vectors[np.argmax(np.abs(vectors[:, k])), k]) or 1.0
    return Whitener(n, tuple(sums), values[by], vectors, trace)


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """sum over dimensions of (n * y - rest)**2, where n * y - rest = n * x - S."""
    most = n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)
    if most * most * max(1, y.shape[1]) < LIMIT:
        z = y * n - np.array(rest, np.int64)
        return (z * z).sum(1).tolist()
    out = []
    for row in y.tolist():
        d = sum((n * a - b) ** 2 for a, b in zip(row, rest, strict=True))
        out.append(d if d < 2 ** 63 else None)
    return out


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", top: int = TOP) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row
    per usable vector and component, ``top`` components at most."""
    spark = vectors.sparkSession
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double")
    rows = (vectors.where(usable(embedding))
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("c")))
    model = fit(rows)
    few = 0 if model is None else min(top, len(model.values))
    if not few:
        return spark.createDataFrame([], schema + ", identity_error double")
    n, dim = model.n, len(model.sums)
    shifted = [s - SHIFT * n for s in model.sums]
    centre = np.array([(2 * s + n) // (2 * n) for s in shifted], np.int64)
    rest = [s - n * int(m) for s, m in zip(shifted, centre, strict=True)]  # S - n * centre
    offset = np.array([r / n for r in rest])
    turn = model.vectors[:, :few] / np.sqrt(model.values[:few])
    explained = model.values[:few] / model.trace

    def project(x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - centre - offset if np.abs(x).max(initial=0) >= 2 ** 61 else (x - centre) - offset) @ turn

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _slices(batches, dim):
            k = some.num_rows
            deviation = _deviations(x - centre if np.abs(x).max(initial=0) < 2 ** 61 else x.astype(object) - centre, n, rest)
            at = pa.array(np.repeat(np.arange(k), few))
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id").take(at), pa.array(np.tile(np.arange(1, few + 1, dtype=np.int32), k)),
                 pa.array(np.full(k * few, n)), pa.array(deviation, pa.int64()).take(at),
                 pa.array(project(x).reshape(-1)), pa.array(np.tile(explained, k))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = np.zeros(few), np.zeros((few, few))
        for _, x in _slices(batches, dim):
            w = project(x)
            one += w.sum(0)
            two += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(few + few * few)), pa.array(np.append(one, two.reshape(-1)))],
                                         names=["cell", "v"])

    # whitened values are centred but for rounding, which their mean takes out
    got = rows.select("c").mapInArrow(moments, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    m = np.array([r.v for r in sorted(got)]) / n
    error = float(np.abs(m[few:].reshape(few, few) - np.outer(m[:few], m[:few]) - np.eye(few)).max())
    return rows.mapInArrow(apply, schema).withColumn("identity_error", F.lit(error))
