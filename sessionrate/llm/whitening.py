"""Operator 13: embedding whitening by FEAST contour integration.

An entry c becomes the whole number x = floor(64 c) + 1,000,000, so that sums, and the
distance of a row from the mean, are exact.  Spark adds up the count and the sums of every
dimension, then the products of the centred entries; what reaches the driver are one row
per dimension and one per pair of dimensions, whatever the number of vectors.  Of that
covariance V the leading components are found so:

1. Householder reflections make V tridiagonal once; the signs of the pivots of its LDL'
   factorisation at a shift count the eigenvalues below it (Sylvester's inertia).
2. The spectrum is cut, by such counts alone, into intervals of a few eigenvalues each, with
   the cuts in its widest gaps.
3. Each interval is the diameter of a circle in the complex plane.  Gauss-Legendre quadrature
   of solves (zI - V) Y = B along it applies the projector onto the interval's eigenvectors
   to a block B; Rayleigh-Ritz on that block gives values and vectors, which are the next
   block, until the residuals are at rounding level.
4. The number of values found in an interval must equal its inertia count; else the block
   is widened and the interval searched again, and no result is given if that does not help.
   A last Rayleigh-Ritz step over all intervals makes all vectors orthogonal.

Whitened values are the projections of the centred rows over the root of the eigenvalue; their
own covariance is taken from all rows, centred, and compared with the identity.

Defined cases: rows whose vector is NULL or holds a NULL, a NaN or an infinite entry are
dropped, as are those with an entry beyond 2**40 in size (no exact long); where vectors have
several lengths the commonest counts (of several the longest) and other rows are dropped.
Repeated rows count as often as they occur and appear as often; extra columns are ignored.
Components whose eigenvalue is zero to rounding do not exist, so a table of one vector, or
of equal ones, gives no rows, as does an empty one.  ``deviation`` raises an error where it
exceeds a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 40)
PER_INTERVAL = 10          # eigenvalues per contour, at most (but for equal ones)
NODES = 12                 # quadrature nodes on the half circle
ROUNDS = 30
_EPS = np.finfo(float).eps
_TINY = np.finfo(float).tiny


# -------------------------------------------------------- counting eigenvalues
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``v``."""
    a = np.array(v, dtype=float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        part = a[k + 1:, k + 1:]
        p = part @ x
        q = p - (x @ p) * x
        part -= 2 * (np.outer(x, q) + np.outer(q, x))
        a[k + 1:, k] -= 2 * x * (x @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def below(diag: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each shift: negative pivots of LDL' = T - shift."""
    shifts = np.atleast_1d(np.asarray(shifts, dtype=float))
    count = np.zeros(len(shifts), dtype=np.int64)
    pivot = np.ones(len(shifts))
    for i, d in enumerate(diag):
        square = off[i - 1] ** 2 if i else 0.0
        pivot = d - shifts - (square / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < _TINY / _EPS, -_TINY / _EPS, pivot)
        count += pivot < 0
    return count


def _cut(count, low: float, high: float) -> float:
    """A point between two bounds in the widest gap between eigenvalues, off the rims."""
    grid = np.linspace(low, high, 66)[1:-1]
    n, left, right = count(grid), *count(np.array([low, high]))
    best, widest = grid[len(grid) // 2], 0
    start = 0
    for i in range(1, len(grid) + 1):
        if i == len(grid) or n[i] != n[start]:
            if left < n[start] < right and i - start > widest:
                best, widest = (grid[start] + grid[i - 1]) / 2, i - start
            start = i
    return best


def intervals(diag: np.ndarray, off: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) from the top of the spectrum down, until ``wanted`` are covered."""
    reach = np.abs(diag) + np.abs(np.append(off, 0)) + np.abs(np.insert(off, 0, 0))
    top = float(reach.max()) if len(diag) else 0.0
    if top == 0:
        return []
    floor = 4 * len(diag) * _EPS * top
    count = lambda s: below(diag, off, s)
    todo, out, found = [(floor, top * (1 + 1e-6))], [], 0
    while todo and found < wanted:
        low, high = todo.pop()
        n = int(np.diff(count(np.array([low, high])))[0])
        if not n:
            continue
        if n <= PER_INTERVAL or high - low < 1e-9 * high:
            out.append((low, high, n))
            found += n
        else:
            mid = _cut(count, low, high)
            todo += [(low, mid), (mid, high)]
    return out


# ---------------------------------------------------------- contour integration
def feast(v: np.ndarray, low: float, high: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenvalues of ``v`` in [low, high] and their vectors."""
    d = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    turns = radius * np.exp(1j * np.pi * (1 + x) / 2)
    scale = np.abs(v).sum(axis=1).max()
    for width in (min(d, n + n // 2 + 4), min(d, 2 * n + 16), d):
        block = np.random.default_rng(width).standard_normal((d, width))
        best = np.inf
        for _ in range(ROUNDS):
            spread = sum(w_j / 2 * (t * np.linalg.solve((centre + t) * np.eye(d) - v, block)).real
                         for w_j, t in zip(w, turns))
            basis = np.linalg.qr(spread)[0]
            values, small = np.linalg.eigh(basis.T @ v @ basis)
            block = basis @ small
            inside = np.flatnonzero((values >= low) & (values <= high))
            off = np.linalg.norm(v @ block - block * values, axis=0)[inside]
            worst = off.max() if len(inside) else np.inf
            if len(inside) == n and (worst < 8 * _EPS * scale or (worst < 1e-12 * scale and worst > best / 2)):
                return values[inside], block[:, inside]
            best = min(best, worst) if len(inside) == n else np.inf
    raise RuntimeError(f"{n} eigenvalues lie in [{low}, {high}], not all of them were found")


def leading(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (fewer if others are zero), falling, and unit vectors."""
    if not len(v):
        return np.empty(0), np.empty((0, 0))
    found = [feast(v, *cut) for cut in intervals(*tridiagonal(v), k)]
    if not found:
        return np.empty(0), np.empty((len(v), 0))
    basis = np.linalg.qr(np.concatenate([q for _, q in found], axis=1))[0]
    values, small = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values)[:k]
    vectors = basis @ small[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * signs


# ---------------------------------------------------------------- Spark jobs
def good(vec: Column) -> Column:
    """Vectors without NULL, non-finite or oversized entries."""
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(column) -> np.ndarray:
    """(rows, dimensions) of an Arrow list column without NULLs."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _added(rows: DataFrame, matrix) -> np.ndarray:
    """Sum over all rows of an array that ``matrix(batch)`` gives per batch, as one flat array.

    Tasks add up their batches; Spark adds up the tasks, cell by cell."""
    def run(batches):
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                part = matrix(batch).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "part"])

    kind = "long" if matrix.whole else "double"
    got = (rows.mapInArrow(run, f"cell long, part {kind}").groupBy("cell").agg(F.sum("part").alias("part"))
               .toPandas())                          # dimensions squared, at most
    out = np.zeros(len(got), dtype=np.int64 if matrix.whole else float)
    out[got["cell"].to_numpy(dtype=np.int64)] = got["part"].to_numpy()
    return out


class _Sums:
    """Sums per column."""

    def __init__(self, of, whole=False):
        self.of, self.whole = of, whole

    def __call__(self, batch):
        return self.of(batch).sum(axis=0)


class _Products:
    """Products of the columns, each less its mean."""
    whole = False

    def __init__(self, of, means=0.0):
        self.of, self.means = of, means

    def __call__(self, batch):
        x = self.of(batch) - self.means
        return x.T @ x


@dataclass
class Whitening:
    """A fitted whitening; ``apply`` gives key, deviation and whitened values of all rows."""
    rows: DataFrame
    n: int
    sums: np.ndarray           # exact, per dimension
    values: np.ndarray         # eigenvalues, falling
    vectors: np.ndarray        # one column per component
    trace: float
    identity_error: float

    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist()

    def apply(self) -> DataFrame:
        n, sums = self.n, self.sums
        project, whole = _projection(self.values, self.vectors), _Whole(n, sums)

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                x = whole(batch)
                if n and len(x) and (x.astype(float) ** 2).sum(axis=1).max() > 2.0 ** 63 * (1 - 1e-9):
                    raise OverflowError("a deviation exceeds a long")
                white = pa.array(list((x / n) @ project), type=pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array((x * x).sum(axis=1, dtype=np.int64), type=pa.int64()), white],
                    [batch.schema.names[0], "deviation", "whitened"])

        key = self.rows.schema[0]
        return self.rows.mapInArrow(run, f"`{key.name}` {key.dataType.simpleString()}, deviation long, "
                                         "whitened array<double>")


def _entries(batch) -> np.ndarray:
    c = _matrix(batch.column(1)).astype(float)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


class _Whole:
    """n x - S of every entry: the centred entries times n, exact."""

    def __init__(self, n, sums):
        self.n, self.sums = n, sums

    def __call__(self, batch):
        x = _entries(batch)
        return self.n * x - self.sums if len(x) else x.reshape(0, len(self.sums))


def _projection(values, vectors):
    return vectors / np.sqrt(values) if len(values) else vectors


def fit(df: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = COMPONENTS) -> Whitening | None:
    """Whitening by all usable vectors of ``df``; None if there are none."""
    rows = df.select(F.col(key).alias("_key"), F.col(vec).alias("_vec")).filter(good(F.col("_vec")))
    sizes = rows.groupBy(F.size("_vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None or not most["d"]:
        return None
    n, d = most["n"], most["d"]
    rows = rows.filter(F.size("_vec") == d)
    sums = _added(rows, _Sums(_entries, whole=True))
    whole = _Whole(n, sums)
    centred = lambda batch: whole(batch) / n
    v = _added(rows, _Products(centred)).reshape(d, d) / n
    v = (v + v.T) / 2
    values, vectors = leading(v, k)
    project = _projection(values, vectors)
    white = lambda batch: centred(batch) @ project
    error = 0.0
    if len(values):
        means = _added(rows, _Sums(white)) / n
        own = _added(rows, _Products(white, means)).reshape(len(values), -1) / n
        error = float(np.abs(own - np.eye(len(values))).max())
    return Whitening(rows, n, sums, values, vectors, float(np.trace(v)), error)


SCHEMA = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(df: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """key, component (from 1), n, deviation, whitened, explained, identity_error: one row per
    usable vector and component."""
    kind = df.schema[key].dataType.simpleString()
    model = fit(df, key, vec, k)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, {SCHEMA}")
    shares = F.array(*[F.lit(x) for x in model.explained()])
    out = model.apply().select(F.col("_key").alias(key), "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return out.select(key, (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                      "deviation", "whitened", F.get(shares, F.col("_at")).alias("explained"),
                      F.lit(model.identity_error).alias("identity_error"))
