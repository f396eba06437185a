"""Whitening of embeddings by the eigenvectors of their covariance.

Vectors are put on a grid of whole numbers, ``floor(256 c)``, so that sums and
deviations are exact. The covariance is that of the distinct vectors: they are
written once, their number and sums are added exactly, and a second pass adds
the products of centred rows, block by block, in streams whose memory is the
size of the matrix. Partial sums of tasks meet in two rounds, salted first, so
that no task reads more than a part of them.

What is left depends on the dimension alone and is solved on the driver:
Householder reflections bring the matrix to tridiagonal form, Sturm counts
bisect its leading eigenvalues, inverse iteration finds their vectors, those of
a cluster orthogonalised against each other, and the reflections take them
back. Mean and components are broadcast and every row is projected.

Defined results: a null vector, one with a null or non-finite entry, and one
whose length is not the most frequent one (ties: the longer) take no part.
Entries beyond the range of a long stop at its ends. A repeated vector counts
once in the fit; each of its rows is returned. A deviation beyond a long is
null. A component without variance (fewer distinct vectors than components,
say) has a null whitened value and explains nothing; with no variance at all
``explained`` is null. An empty table, and vectors without entries, give no
row. Columns other than the id and the vector are not read; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from indicata.llm.common import discard, materialize, ship

GRID, COMPONENTS = 256, 4
#: Salts of the first round of sums.
SALTS = 32
#: Rows of the covariance that meet in one block.
BLOCK = 256
#: Bits of a limb of a sum, in products with entries.
LIMB = 24
EPS = np.finfo(float).eps

OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
       "identity_error double")


# -- the symmetric eigenproblem -------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors of a symmetric matrix."""
    a = np.array(a, float)
    d = len(a)
    off, mirrors = np.zeros(max(d - 1, 0)), []
    for k in range(d - 2):
        x = a[k + 1:, k]
        scale = np.abs(x[1:]).max()
        v = np.zeros(d - k - 1)
        if scale > 0:
            size = np.abs(x).max()
            v = x / size
            alpha = -np.copysign(np.sqrt(v @ v), v[0])
            v[0] -= alpha
            v /= np.sqrt(v @ v)
            p = a[k + 1:, k + 1:] @ v
            w = 2 * (p - (v @ p) * v)
            a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
            off[k] = alpha * size
        else:
            off[k] = x[0]
        mirrors.append(v)
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return np.diag(a).copy(), off, mirrors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix are less than each of ``at``."""
    tiny = np.finfo(float).tiny / EPS
    count, q = np.zeros(len(at), int), np.ones(len(at))
    with np.errstate(over="ignore"):
        for i in range(len(diagonal)):
            q = diagonal[i] - at - (off[i - 1] * (off[i - 1] / q) if i else 0)
            q = np.where(np.abs(q) < tiny, -tiny, q)
            count += q < 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` greatest eigenvalues, falling, by bisection of Sturm counts."""
    d = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    pad = 2 * d * EPS * max(np.abs(low[0]), np.abs(high[0]))
    low, high = low - pad, high + pad
    rank = d - 1 - np.arange(k)  # eigenvalue number rank has that many below it
    for _ in range(2000):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def shifted_solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solves ``(T - shift) x = b`` by elimination with row exchanges; a pivot
    under ``least`` is raised to it, as ``T - shift`` is singular by intent."""
    d = len(diagonal)
    x = b.copy()
    u = np.zeros((d, 3))
    u[:, 0] = diagonal - shift
    u[:-1, 1] = off
    for i in range(d - 1):
        under = off[i]
        if abs(under) > abs(u[i, 0]):
            u[i], u[i + 1] = (under, u[i + 1, 0], u[i + 1, 1]), (u[i, 0], u[i, 1], 0)
            x[i], x[i + 1] = x[i + 1], x[i]
            f = u[i + 1, 0] / u[i, 0]
            u[i + 1] = (u[i + 1, 1] - f * u[i, 1], -f * u[i, 2], 0)
        else:
            if abs(u[i, 0]) < least:
                u[i, 0] = least
            f = under / u[i, 0]
            u[i + 1, 0] -= f * u[i, 1]
        x[i + 1] -= f * x[i]
    if abs(u[-1, 0]) < least:
        u[-1, 0] = least
    x[-1] /= u[-1, 0]
    for i in range(d - 2, -1, -1):
        x[i] -= u[i, 1] * x[i + 1] + (u[i, 2] * x[i + 2] if i + 2 < d else 0)
        x[i] /= u[i, 0]
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of a tridiagonal matrix, a column for each of ``values``.

    Values closer than a thousandth of the matrix's norm make a cluster: their
    shifts are kept apart and each vector is orthogonalised, twice, against
    the vectors of its cluster found before, in every iteration.
    """
    d, norm = len(diagonal), max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    vectors = np.zeros((d, len(values)))
    if norm == 0:
        return np.eye(d)[:, :len(values)]
    rng, first, last = np.random.default_rng(7), 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = value if last is None or first == j else min(value, last - 10 * EPS * norm)
        last = shift
        x = rng.standard_normal(d)
        for _ in range(6):
            x = shifted_solve(diagonal, off, shift, x / np.sqrt(x @ x), EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                for i in range(first, j):
                    x -= (vectors[:, i] @ x) * vectors[:, i]
            x /= np.sqrt(x @ x)
        vectors[:, j] = x
    return vectors


def components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues of a symmetric matrix, falling, and their
    unit vectors (columns; the entry of greatest size is positive)."""
    k = min(k, len(a))
    diagonal, off, mirrors = tridiagonal(a)
    values = leading(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(mirrors) - 1, -1, -1):
        v = mirrors[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    vectors /= np.sqrt((vectors ** 2).sum(0))
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    return values, vectors * sign


# -- sums over executors ----------------------------------------------------------

def summed(parts: DataFrame, dtype: str, spread: bool = True) -> dict[int, np.ndarray]:
    """Elementwise sums of ``(part int, data binary)`` by part, as arrays.

    The parts are few (their number depends on the dimension); the rows, some
    for each task, are added in streams, first within salts. The sums alone
    come to the driver.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, blob in zip(b["part"].to_pylist(), b["data"].to_pylist(), strict=True):
                x = np.frombuffer(blob, dtype)
                if part in sums:
                    sums[part] += x
                else:
                    sums[part] = x.copy()
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array(
            [x.tobytes() for x in sums.values()], pa.binary())], ["part", "data"])

    kinds = "part int, data binary"
    if spread:
        salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        parts = salted.repartition("part", "salt").select("part", "data").mapInArrow(add, kinds)
    found = parts.repartition("part").mapInArrow(add, kinds)
    return {r.part: np.frombuffer(r.data, dtype) for r in found.collect()}  # a row for each part


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a batch's arrays of longs."""
    return column.values.slice(column.offsets[0].as_py(), len(column) * d).to_numpy(zero_copy_only=False) \
        .reshape(len(column), d)


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and sum of every dimension, as whole numbers of any
    size: entries are added in halves, and sums of tasks in three limbs."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = matrix(b["x"], d)
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        high, low = high + (low >> 32), low & 0xFFFFFFFF
        limbs = np.concatenate([[n], high >> 32, high & 0xFFFFFFFF, low])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([limbs.tobytes()], pa.binary())],
                                         ["part", "data"])

    got = summed(fit.select("x").mapInArrow(part, "part int, data binary"), "int64")
    if not got:
        return 0, [0] * d
    limbs = got[0][1:].reshape(3, d).tolist()
    return int(got[0][0]), [(((a << 32) + b) << 32) + c for a, b, c in zip(*limbs, strict=True)]


def covariance(fit: DataFrame, n: int, mean: np.ndarray) -> np.ndarray:
    """Covariance of the fit list (divisor ``n``), rows centred before products.
    The mean travels in two parts, so that centring loses nothing to its size."""
    d = len(mean[0])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d)), False
        for b in batches:
            x = centred(matrix(b["x"], d), mean)
            total += x.T @ x
            seen = True
        if seen:
            for at in range(0, d, BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK], pa.int32()), pa.array(
                    [total[at:at + BLOCK].tobytes()], pa.binary())], ["part", "data"])

    got = summed(fit.select("x").mapInArrow(part, "part int, data binary"), "float64")
    v = np.concatenate([got[i].reshape(-1, d) for i in sorted(got)]) / n
    return (v + v.T) / 2


def split_mean(n: int, sums: list[int]) -> np.ndarray:
    """``sums / n`` as whole part (first row) and rest (second row)."""
    whole = [s // n for s in sums]
    return np.array([whole, [(s - w * n) / n for s, w in zip(sums, whole, strict=True)]], float)


def centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return (x - mean[0]) - mean[1]


# -- the operator -------------------------------------------------------------------

def on_grid(vector: Column) -> Column:
    """Entries as longs: ``floor(256 c)``, stopping at the ends of a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * GRID))


def usable(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the rows whose vector has finite entries only."""
    v = F.col("embedding")
    ok = F.coalesce(F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    return embeddings.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), on_grid(v).alias("x"))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of ``(n x - S)^2``, exact; null beyond a long.

    As ``n^2 x.x - 2 n x.S + S.S``, whose products with x fit longs when S is
    cut into limbs; only rows with huge entries are computed entry by entry.
    """
    top, d = max(abs(int(x.max())), abs(int(x.min())), 1), len(sums)
    if top * max(top, 1 << LIMB) * d < 2 ** 63:
        low = (1 << LIMB) - 1
        limbs = [[s & low, s >> LIMB & low, s >> 2 * LIMB] for s in sums]
        dots = [a + (b << LIMB) + (c << 2 * LIMB) for a, b, c in (x @ np.array(limbs, np.int64)).tolist()]
        square = sum(s * s for s in sums)
        exact = [n * n * a - 2 * n * b + square for a, b in zip((x * x).sum(1).tolist(), dots, strict=True)]
    else:
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [e if e < 2 ** 63 else None for e in exact]


def whiten(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """Rows ``(vec_id, component, n, deviation, whitened, explained,
    identity_error)``, one for each usable vector and component up to ``k``."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None or lengths.d == 0:
        return spark.createDataFrame([], OUT)
    d = lengths.d
    rows = rows.filter(F.size("x") == d)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(fit, d)
    mean = split_mean(n, sums)
    v = covariance(fit, n, mean)
    trace = float(np.trace(v))
    values, vectors = components(v, k)
    k = len(values)
    live = values > d * EPS * max(trace, np.finfo(float).tiny)
    scaled = vectors / np.sqrt(np.where(live, values, 1))
    explained = (np.where(live, values, 0) / trace).tolist() if trace > 0 else [None] * k
    error = identity_error(fit, n, mean, scaled, live)
    discard(fit)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = matrix(b["x"], d)
            white = centred(x, mean) @ scaled
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                b["vec_id"].take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array([e for e in deviations(x, n, sums) for _ in range(k)], pa.int64()),
                pa.array(white.ravel(), mask=np.tile(~live, m)),
                pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * k), pa.float64())], [f.split(" ")[0] for f in OUT.split(", ")])

    return rows.mapInArrow(project, OUT)


def identity_error(fit: DataFrame, n: int, mean: np.ndarray, scaled: np.ndarray, live: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity,
    measured on the data, over the components that have variance."""
    d, k = scaled.shape

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            w = centred(matrix(b["x"], d), mean) @ scaled
            total += np.vstack([w.T @ w, w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["part", "data"])

    got = summed(fit.select("x").mapInArrow(part, "part int, data binary"), "float64")
    total = got[0].reshape(k + 1, k) / n
    gap = total[:k] - np.outer(total[k], total[k]) - np.eye(k)
    return float(np.abs(gap[np.ix_(live, live)]).max(initial=0.0))


ship(__name__)
