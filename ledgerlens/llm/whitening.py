"""Embedding whitening: principal components by FEAST contour integration.

The fit list is every distinct quantised vector once.  Its sums and its centred
products are added up in the tasks that hold it, as exact integers, and only a
matrix of d x d numbers (d: the vectors' length) reaches the driver.  There the
wanted components are found interval by interval:

* inertia counts (negative pivots of the shifted matrix in tridiagonal form) say
  how many eigenvalues lie above a value; bisection on them chooses an interval
  that holds the largest ones and ends in a gap;
* a block of vectors is projected on the interval's eigenvectors by quadrature of
  complex shifted solves around it, Rayleigh-Ritz gives eigenvalues and vectors
  of the projected space, and both are repeated until the residuals vanish;
* the components are taken only when there are as many inside the interval as
  its inertia counts ask for; a block that misses some is widened.

Every row is then projected, centred, on the components in its own task.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries go.  So do rows whose vector is not as long as most fit vectors are (the
longer length on a tie).  Entries beyond a long once quantised keep the largest
long.  Components without variance are left out, so one vector, or equal
ones, give no rows.  ``deviation`` is NULL where it is beyond a long.  Repeated
rows and null ids each get their rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Components returned.
COMPONENTS = 4
#: Steps of one unit of an entry.
SCALE = 256
#: Quadrature points on the upper half of a contour.
POINTS = 8
#: Rounds of projection before the block is widened.
ROUNDS = 12
#: Components up to this share of the trace count as without variance.
NO_VARIANCE = 1e-14
#: The longest vectors: a matrix of 128 MB on the driver.
MAX_LENGTH = 4096
#: Vectors summed by a task: many more than a matrix has rows, so that the tasks'
#: matrices are small against the vectors.
TASK_VECTORS = 1 << 16
#: Exact sums are split here.
HALF = 1 << 64
#: Entries of vectors handled at a time in a task.
TASK_ENTRIES = 1 << 20


# ---- components of a symmetric matrix ------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a similar tridiagonal matrix (Householder)."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if not size:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        p = a[k + 1:, k + 1:] @ x
        w = 2 * (p - (x @ p) * x)
        a[k + 1:, k + 1:] -= np.outer(x, w) + np.outer(w, x)
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
    return np.diag(a).copy(), np.diag(a, -1) ** 2


def above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Inertia: how many eigenvalues are larger than ``shift`` (positive pivots)."""
    diagonal, squares = form
    tiny = np.finfo(float).tiny
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (squares[i - 1] / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def nth_largest(form, n: int, low: float, high: float, width: float) -> float:
    """The n-th largest eigenvalue to within ``width``, by bisection on inertia."""
    while high - low > width:
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if above(form, mid) >= n:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def interval_of_largest(form, k: int, size: float) -> tuple[float, float, int]:
    """An interval (low, high) that holds the ``k`` largest eigenvalues, or a few
    more where that puts its lower end into a wider gap, and how many it holds."""
    n = len(form[0])
    width = size * 1e-6
    bottom, top = -size, size * (1 + 1e-6)
    most = min(n, 2 * k + 4)
    values = [nth_largest(form, i, bottom, top, width) for i in range(1, most + 1)]
    gaps = [values[m - 1] - (values[m] if m < most else (bottom if m == n else values[m - 1])) for m in range(k, most + 1)]
    m = k + int(np.argmax(gaps))
    low = bottom if m == n else values[m - 1] - gaps[m - k] / 2
    return low, top, above(form, low)


def projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part in the eigenvectors of the interval: Gauss quadrature of the
    resolvent on a circle around it (the lower half is the conjugate of the upper)."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    eye = np.eye(len(matrix))
    out = np.zeros_like(block)
    for node, weight in zip(nodes, weights):
        turn = np.exp(1j * np.pi / 2 * (1 - node))
        solved = np.linalg.solve((centre + radius * turn) * eye - matrix, block.astype(complex))
        out += weight / 2 * radius * (turn * solved).real
    return out


def rayleigh_ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit vectors of the matrix within the block's span, falling."""
    basis, _ = np.linalg.qr(block)
    basis, _ = np.linalg.qr(basis)
    values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis @ turns[:, order]


def largest_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) of a symmetric matrix without negative
    ones, and their unit eigenvectors as columns; those without variance are left out.

    A vector's sign makes its largest entry (the first on a tie) positive."""
    n = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0
    if not size:
        return np.zeros(0), np.zeros((n, 0))
    form = tridiagonal(matrix)
    low, high, wanted = interval_of_largest(form, min(k, n), size)
    columns = min(n, wanted + max(4, wanted // 2))
    rng = np.random.default_rng(0)
    while True:
        block = rng.standard_normal((n, columns))
        for _ in range(ROUNDS):
            if columns < n:
                block = projected(matrix, block, low, high)
            values, vectors = rayleigh_ritz(matrix, block)
            inside = (values > low) & (values < high)
            rest = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside])
            if inside.sum() == wanted and rest.max(initial=0) <= size * 4e-16 * n:
                break
            block = vectors
        else:
            if columns == n:  # the whole space: its Ritz vectors are the eigenvectors
                break
            columns = min(n, 2 * columns)
            continue
        break
    values, vectors = values[:min(k, n)], vectors[:, :min(k, n)]
    kept = values > NO_VARIANCE * np.trace(matrix)
    values, vectors = values[kept], vectors[:, kept]
    lead = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)


# ---- passes over the vectors ----------------------------------------------

def quantised(rows: DataFrame, vector_col: str) -> DataFrame:
    """The rows with a usable vector, which becomes longs (column ``x``)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(
        F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(True))
    return rows.where(good).withColumn("x", F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint")))


def matrices(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, vectors as rows of int64) of a column of equally long vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    step = max(1, TASK_ENTRIES // length)
    for lo in range(0, len(column), step):
        part = column.slice(lo, step)
        yield lo, lo + len(part), np.asarray(part.flatten(), np.int64).reshape(len(part), length)


def task_sums(fit: DataFrame, length: int, places: int, exact: bool, measure) -> list:
    """What ``measure`` makes of every run of vectors (a flat array of ``places`` numbers
    each time), added up in each task and then by place.  There are as many places as
    numbers in a d x d matrix at most, and only their totals reach the driver.

    Exact integers travel in two halves, so that no sum overflows."""
    def run(batches):
        total = None
        for batch in batches:
            for _, _, x in matrices(batch.column(0), length):
                part = measure(x)
                total = part if total is None else total + part
        if total is None:
            return
        if exact:
            halves = [divmod(int(t), HALF) for t in total]
            columns = [pa.array([str(h[i]) for h in halves]) for i in (0, 1)]
        else:
            columns = [pa.array(total), pa.array(np.zeros(places))]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(places), pa.int32()), *columns], names=["place", "upper", "lower"])

    kind = "string" if exact else "double"
    rows = fit.select("x").mapInArrow(run, f"place int, upper {kind}, lower {kind}")
    if exact:
        rows = rows.select("place", F.col("upper").cast("decimal(28,0)").alias("upper"), F.col("lower").cast("decimal(20,0)").alias("lower"))
    out = [0] * places
    for place, upper, lower in rows.groupBy("place").agg(F.sum("upper"), F.sum("lower")).collect():
        out[place] = int(upper) * HALF + int(lower) if exact else upper
    return out


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums by column, in Python integers (upper and lower halves are added apart)."""
    upper = (x >> 20).sum(axis=0).astype(object)
    return upper * (1 << 20) + (x & ((1 << 20) - 1)).sum(axis=0).astype(object)


def centred_products(centre: np.ndarray):
    """Products of the vectors less ``centre`` (whole numbers near the mean), and the sums
    of what is left of them.  In integers as long as these cannot overflow a double's
    exact range; vectors further out are multiplied as Python integers."""
    def measure(x: np.ndarray) -> np.ndarray:
        y = x - centre
        reach = float(np.abs(y.astype(float)).max(initial=0))
        if reach * reach * len(y) < 2.0 ** 53 and np.abs(x.astype(float)).max(initial=0) < 2.0 ** 62:
            f = y.astype(float)
            products, left = (f.T @ f).astype(np.int64).astype(object), y.sum(axis=0).astype(object)
        else:
            y = x.astype(object) - centre.astype(object)
            products, left = y.T.dot(y), y.sum(axis=0)
        return np.concatenate((products.ravel(), left))
    return measure


class Whitening:
    """Mean, components and eigenvalues of a fit list."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.trace = n, sums, trace
        self.values, self.vectors = values, vectors
        self.centre = np.array([s // n for s in sums], object)
        self.rest = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off exactly."""
        y = x - self.centre if np.abs(x.astype(float)).max(initial=0) >= 2.0 ** 62 else x - self.centre.astype(np.int64)
        return y.astype(float) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """By row, so that a row's numbers do not depend on the rows beside it."""
        y = self.centred(x)
        return np.stack([(y * v).sum(axis=1) for v in self.vectors.T], axis=1) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n*x - S)**2 of each row; None beyond a long."""
        far = float(np.abs(self.centred(x)).max(initial=0)) * self.n
        if far * far * x.shape[1] < 2.0 ** 62 and np.abs(x.astype(float)).max(initial=0) * self.n < 2.0 ** 62:
            d = x * self.n - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = x.astype(object) * self.n - np.array(self.sums, object)
        return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]


def fit_whitening(fit: DataFrame, length: int, n: int, components: int = COMPONENTS) -> Whitening:
    """The fit over ``n`` distinct vectors (column ``x``)."""
    sums = task_sums(fit, length, length, True, column_sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    made = task_sums(fit, length, length * length + length, True, centred_products(centre))
    left = made[length * length:]
    # exact integers up to the last division
    matrix = np.array([[(made[i * length + j] * n - left[i] * left[j]) / (n * n) for j in range(length)] for i in range(length)])
    matrix = (matrix + matrix.T) / 2
    values, vectors = largest_components(matrix, components)
    return Whitening(n, sums, values, vectors, float(np.trace(matrix)))


def identity_error(fit: DataFrame, length: int, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, measured."""
    k = len(model.values)

    def products(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x)
        return np.concatenate(((w.T @ w).ravel(), w.sum(axis=0)))

    made = np.array(task_sums(fit, length, k * k + k, False, products)) / model.n
    mean = made[k * k:]
    return float(np.abs(made[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, *, vector_col: str = "embedding", id_col: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: id, component, n, deviation,
    whitened, explained, identity_error."""
    spark = rows.sparkSession
    usable = quantised(rows, vector_col).select(F.col(f"`{id_col}`").alias("id"), "x")
    fit = usable.select("x").distinct().checkpoint()
    id_type = usable.schema["id"].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    # the most common length: one row of two numbers
    common = fit.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    length, n = int(common["length"]), int(common["count"])
    if length > MAX_LENGTH:
        raise ValueError(f"vectors of {length} entries: more than {MAX_LENGTH}")
    fit = fit.where(F.size("x") == length).coalesce(-(-n // TASK_VECTORS))
    model = fit_whitening(fit, length, n, components)
    k = len(model.values)
    if not k:
        return spark.createDataFrame([], schema)
    error = identity_error(fit, length, model)
    explained = model.values / model.trace
    columns = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, x in matrices(batch.column(1), length):
                m = hi - lo
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, m).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                    pa.array([d for d in model.deviation(x) for _ in range(k)], pa.int64()),
                    pa.array(model.whitened(x).ravel()), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error))], names=columns)

    return usable.where(F.size("x") == length).mapInArrow(run, schema)
