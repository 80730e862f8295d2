"""Embedding whitening with a covariance of all vectors and an own symmetric eigensolver for its leading part.

1. One pass counts the vectors and sums every dimension exactly (whole numbers).
2. One pass centres every vector (subtracting the mean first, then multiplying) and sums the outer products of a
   task; the tasks' matrices are summed row by row in two steps, so no task receives more than a share of them.
3. The driver holds one matrix of dim x dim (bounded by the vectors' length): Householder reflections make it
   tridiagonal, Sturm counts bisect the leading eigenvalues, inverse iteration gives their vectors, and vectors
   whose eigenvalues lie close together are made orthogonal to each other while they are iterated.
4. The mean and the components (dim x k numbers) go to every task, which projects its rows.
5. The covariance of the projections is measured on all rows and compared with the identity.

Defined cases: vectors that are null, empty or hold null or non-finite entries are dropped; vectors of different
lengths are whitened apart, each length by its own fit; components whose eigenvalue is zero up to rounding (fewer
distinct vectors than dimensions, constant dimensions) have no whitened value and are left out, so equal vectors
alone give no row; repeated ids and a null vec_id are rows of their own; other columns are ignored; an empty table
gives no row. Entries beyond 2**53 / scale raise ``ArithmeticError``, as whole numbers are not exact there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


# ---- symmetric eigenvalues -----------------------------------------------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors v (a reflection is x - 2 v (v . x)) of the symmetric ``a``."""
    a, n = a.copy(), len(a)
    vs = []
    for k in range(n - 2):
        v = np.zeros(n)
        v[k + 1:] = a[k + 1:, k]
        scale = np.abs(v).max()
        if scale > 0:
            v /= scale
            v[k + 1] += np.copysign(np.sqrt(v @ v), v[k + 1])
            v /= np.sqrt(v @ v)
            p = a @ v
            w = 2 * (p - (v @ p) * v)
            a -= np.outer(v, w) + np.outer(w, v)
        vs.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), vs


def count_below(d: np.ndarray, e: np.ndarray, x: float) -> int:
    """Sturm count: eigenvalues of the tridiagonal matrix (d, e) below ``x``."""
    tiny = np.finfo(float).tiny ** 0.5
    count, q = 0, 1.0
    for i in range(len(d)):
        q = d[i] - x - (e[i - 1] ** 2 / q if i else 0.0)
        if q == 0:
            q = tiny
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection to the last bit that doubles hold."""
    n = len(d)
    reach = np.r_[np.abs(e), 0] + np.r_[0, np.abs(e)]
    low, high = float((d - reach).min()), float((d + reach).max())
    pad = 4 * np.finfo(float).eps * max(abs(low), abs(high), 1e-300)
    out = []
    for i in range(k):
        lo, hi = low - pad, high + pad  # the (i + 1)-th largest is where the count below passes n - i - 1
        while True:
            mid = lo + (hi - lo) / 2
            if not lo < mid < hi:
                break
            if count_below(d, e, mid) >= n - i:
                hi = mid
            else:
                lo = mid
        out.append(lo)
    return np.array(out)


def _solve(d: np.ndarray, e: np.ndarray, x: float, b: np.ndarray, small: float) -> np.ndarray:
    """(T - x) y = b for the tridiagonal T, by elimination with partial pivoting; a pivot of zero becomes ``small``."""
    n = len(d)
    diag, up, up2, y = d - x, np.r_[e, 0.0], np.zeros(n), b.copy()
    low = np.r_[e, 0.0]
    for i in range(n - 1):
        if abs(low[i]) > abs(diag[i]):  # swap rows i and i + 1
            diag[i], low[i] = low[i], diag[i]
            up[i], diag[i + 1] = diag[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        if abs(diag[i]) < small:
            diag[i] = small
        f = low[i] / diag[i]
        diag[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        y[i + 1] -= f * y[i]
    if abs(diag[-1]) < small:
        diag[-1] = small
    for i in range(n - 1, -1, -1):
        rest = (up[i] * y[i + 1] if i + 1 < n else 0.0) + (up2[i] * y[i + 2] if i + 2 < n else 0.0)
        y[i] = (y[i] - rest) / diag[i]
    return y


def leading_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, close: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors (columns) of ``values`` by inverse iteration. Values nearer than ``close`` times the
    matrix's size form a cluster, within which every iterate is made orthogonal to the vectors before it."""
    n = len(d)
    size = max(np.abs(d).max(), np.abs(e).max() if len(e) else 0.0)
    if size == 0:
        return np.eye(n)[:, :len(values)]
    eps = np.finfo(float).eps * size
    rng = np.random.default_rng(7)
    out = np.zeros((n, len(values)))
    first = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > close * size:
            first = i
        y = rng.standard_normal(n)
        for _ in range(6):
            y /= np.abs(y).max()
            y = _solve(d, e, value, y, eps)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= out[:, first:i] @ (out[:, first:i].T @ y)
            y /= np.sqrt(y @ y)
        out[:, i] = y
    return out


def leading_eigen(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) of the symmetric ``a`` and their unit vectors as columns."""
    d, e, vs = tridiagonal(a)
    values = leading_values(d, e, min(k, len(d)))
    x = leading_vectors(d, e, values)
    for v in reversed(vs):
        x -= 2 * np.outer(v, v @ x)
    x /= np.sqrt((x * x).sum(axis=0))
    x *= np.where(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])] < 0, -1.0, 1.0)  # the same sign on every run
    return values, x


# ---- passes over the vectors ---------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Fit:
    """n and exact sums; ``base``: whole numbers next to the mean, ``rest``: the mean less ``base``."""
    n: int
    sums: tuple[int, ...]
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray | None = None
    components: np.ndarray | None = None
    explained: np.ndarray | None = None


def whole(batch: pa.RecordBatch, dim: int, scale: float, shift: int) -> np.ndarray:
    """floor(scale * entry) + shift of a batch's vectors (its last column), as rows of whole numbers."""
    x = np.floor(batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
    if len(x) and np.abs(x).max() >= 2.0 ** 53:
        raise ArithmeticError("an entry times the scale is not exact in double precision")
    return x.astype(np.int64) + shift


def _sums(rows: DataFrame, dim: int, scale: float, shift: int) -> Fit:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = whole(batch, dim, scale, shift)
            n += len(x)
            for at in range(0, len(x), 512):  # the sum of 512 numbers of 2**53 is within a long
                total = [a + int(b) for a, b in zip(total, x[at:at + 512].sum(axis=0), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array([str(t) for t in total])], names=["i", "n", "s"])

    parts = rows.mapInArrow(run, "i int, n long, s string")
    got = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    n, sums = got[0]["n"], tuple(int(r["s"]) for r in got)  # one row per dimension
    base = [(2 * s + n) // (2 * n) for s in sums]
    return Fit(n, sums, np.array(base, np.int64), np.array([(s - n * b) / n for s, b in zip(sums, base, strict=True)]))


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of the tasks' matrices, sent as rows (i, part, row): first within 64 shares of the tasks, then over all."""
    def add(pdf):
        return pdf.iloc[:1].assign(row=[np.sum(np.stack(pdf["row"]), axis=0)])

    kind = "i int, share int, row array<double>"
    once = parts.groupBy("i", "share").applyInPandas(add, kind)
    got = once.groupBy("i").applyInPandas(add, kind).orderBy("i").collect()  # one row per dimension
    return np.array([r["row"] for r in got]).reshape(-1, width)


def _products(rows: DataFrame, dim: int, width: int, scale: float, shift: int, centred) -> np.ndarray:
    """Sum over all vectors of the outer product of ``centred(x)`` (a matrix of ``width`` columns) with itself, and
    in the last row the sum of ``centred(x)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((width + 1, width))
        for batch in batches:
            y = centred(whole(batch, dim, scale, shift))
            total[:width] += y.T @ y
            total[width] += y.sum(axis=0)
        share = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width + 1), pa.int32()), pa.array([share] * (width + 1), pa.int32()), pa.array(list(total))],
            names=["i", "share", "row"])

    return _summed(rows.mapInArrow(run, "i int, share int, row array<double>"), width)


def _covariance(rows: DataFrame, dim: int, width: int, n: int, scale: float, shift: int, centred) -> np.ndarray:
    """Covariance (divisor n) of ``centred(x)``; what is left of its mean is taken out too."""
    total = _products(rows, dim, width, scale, shift, centred)
    mean = total[width] / n
    v = total[:width] / n - np.outer(mean, mean)
    return (v + v.T) / 2


def fit(rows: DataFrame, dim: int, k: int, scale: float, shift: int) -> Fit:
    """The leading components of ``rows`` (vec_id, embedding), vectors of length ``dim``."""
    f = _sums(rows, dim, scale, shift)
    v = _covariance(rows, dim, dim, f.n, scale, shift, lambda x: (x - f.base) - f.rest)
    values, x = leading_eigen(v, k)
    trace = float(np.trace(v))
    good = values > max(trace, 0.0) * dim * 8 * np.finfo(float).eps
    return Fit(f.n, f.sums, f.base, f.rest, values[good], x[:, good], values[good] / trace if trace > 0 else values[good])


def whiten(vectors: DataFrame, k: int = 8, scale: float = 1024.0, shift: int = 100000) -> DataFrame:
    """``vectors`` (vec_id, embedding) -> per vector and component up to ``k``: vec_id, component, n, deviation
    (sum over dimensions of (n x - S)^2), whitened, explained, identity_error. x is floor(scale * entry) + shift."""
    spark = vectors.sparkSession
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    rows = rows.where(e.isNotNull() & (F.size(e) > 0) & ~F.coalesce(bad, F.lit(False)))
    out = spark.createDataFrame([], OUT)
    for (dim,) in sorted(rows.select(F.size("embedding")).distinct().collect()):  # one row per vector length
        some = rows.where(F.size("embedding") == dim)
        out = out.unionByName(_projected(some, dim, fit(some, dim, k, scale, shift), scale, shift))
    return out


def _projected(rows: DataFrame, dim: int, f: Fit, scale: float, shift: int) -> DataFrame:
    axes = f.components / np.sqrt(f.values)  # dim x k: goes to every task
    width = axes.shape[1]

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - f.base) - f.rest) @ axes

    error = 0.0
    if width:
        error = float(np.abs(_covariance(rows, dim, width, f.n, scale, shift, project) - np.eye(width)).max())
    sums = np.array([s - f.n * int(b) for s, b in zip(f.sums, f.base, strict=True)], np.int64)  # at most n in size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(batch, dim, scale, shift)
            y = x - f.base
            if len(y) and (f.n * (float(np.abs(y).max()) + 1)) ** 2 * dim < 2.0 ** 62:
                dev = [str(v) for v in ((f.n * y - sums) ** 2).sum(axis=1).tolist()]
            else:  # beyond a long: whole numbers of any size
                dev = [str(sum((f.n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True))) for r in y]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dev, pa.string()), pa.array(list(project(x)), pa.list_(pa.float64()))],
                                             names=["vec_id", "deviation", "w"])

    got = rows.mapInArrow(run, "vec_id long, deviation string, w array<double>")
    got = got.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.posexplode("w").alias("_at", "whitened"))
    share = F.array(*[F.lit(float(s)) for s in f.explained]) if width else F.array().cast("array<double>")
    return got.select("vec_id", (F.col("_at") + 1).alias("component"), F.lit(f.n).cast("long").alias("n"), "deviation",
                      "whitened", F.get(share, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"))
