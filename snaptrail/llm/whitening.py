"""Whitening of embeddings along principal components that come from spectral divide and conquer.

Spark counts and sums the different vectors and the products of their centred entries, in partial sums per
task, so that only a matrix of dimensions by dimensions reaches the driver. There the covariance is split: the
unitary polar factor of the covariance less a shift, which QDWH iterations give, has the eigenvalues 1 and -1,
so half of it plus the identity projects on the subspace of eigenvalues above the shift. Bases of the subspace
and of its complement cut the matrix in two, and each part is split again until it is one component. The mean
and the components go to all tasks, which whiten all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import stored

# Steps of an entry: it counts as floor(SCALE * entry).
SCALE = 256

COMPONENTS = 4

_EPS = float(np.finfo(float).eps)


def polar(a: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix by QDWH: dynamically weighted Halley steps, each by a QR.

    ``low`` bounds the smallest singular value from below; the weights are the best for that bound, which is
    near 1 after six steps.
    """
    n = len(a)
    # The Frobenius norm bounds the largest singular value; smaller ones than low are zero in double precision.
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    low = _EPS
    for _ in range(rounds):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        before = x
        x = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if np.linalg.norm(x - before) <= 10 * _EPS * n and 1 - low < 1e-8:
            break
    return (x + x.T) / 2


def components(covariance: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as rows, the first ``most`` of them or all.

    Parts that only hold smaller eigenvalues than the ones asked for are not split. Equal eigenvalues, to
    double precision, get some orthonormal vectors of their subspace.
    """
    n = len(covariance)
    most = n if most is None else min(most, n)
    scale = max(float(np.abs(np.trace(covariance))), float(np.linalg.norm(covariance)))
    values, vectors = [], []
    # Parts from that of the smallest eigenvalues to that of the largest, which is taken first.
    parts = [np.eye(n)]
    while parts and len(values) < most:
        basis = parts.pop()
        part = basis.T @ covariance @ basis
        part = (part + part.T) / 2
        halves = None if len(part) == 1 else _split(part, scale)
        if halves is None:
            values.extend(np.diag(part))
            vectors.extend(basis.T)
        else:
            high, low = halves
            parts += [basis @ low, basis @ high]
    order = np.argsort(-np.array(values), kind="stable")[:most]
    # Rayleigh quotients of vectors that are made unit again.
    found = np.array(vectors).reshape(len(values), n)[order]
    found = found / np.linalg.norm(found, axis=1, keepdims=True) if len(found) else found
    return np.einsum("ij,jk,ik->i", found, covariance, found), found


def _split(part: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the subspaces of eigenvalues above and below a shift; None if all eigenvalues are equal.

    The mean eigenvalue lies between the largest and the smallest. A shift that meets an eigenvalue gives no
    projector, and the next one is tried.
    """
    n = len(part)
    mean = np.trace(part) / n
    spread = np.linalg.norm(part - mean * np.eye(n))
    if spread <= n * _EPS * scale:
        return None
    for offset in (0.0, 0.05, -0.05, 0.17, -0.17, 0.31, -0.31, 0.007, -0.007):
        unitary = polar(part - (mean + offset * spread / np.sqrt(n)) * np.eye(n))
        projector = (unitary + np.eye(n)) / 2
        rank = round(float(np.trace(projector)))
        if 0 < rank < n and np.linalg.norm(projector @ projector - projector) <= 1e-8 * n:
            drawn = np.random.default_rng(n).standard_normal((n, rank))
            for _ in range(2):
                drawn = np.linalg.qr(projector @ drawn, mode="complete")[0]
                high, low = drawn[:, :rank], drawn[:, rank:]
                drawn = high
            return high, low
    return None


@dataclass(frozen=True)
class Whitening:
    """What the fit gives: the list's length and sums, and the components with their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    total: float
    identity_error: float


def entries(vector: Column, scale: int = SCALE) -> Column:
    """The steps of a vector's entries, or null if it is null or holds null or entries that are not finite."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda c: F.coalesce((F.abs(c.cast("double")) < infinite) & ~F.isnan(c.cast("double")), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * scale)))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` integers; shorter lists are filled up with zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return values.reshape(len(lengths), dims)
    matrix = np.zeros((len(lengths), dims), np.int64)
    matrix[np.arange(dims) < lengths[:, None]] = values
    return matrix


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """x less the mean in double precision, and the exact sum of (n * x - sum) squared."""
    largest = max(int(np.abs(x.astype(float)).max(initial=0)), 1)
    wide = max(n * largest + max((abs(s) for s in sums.tolist()), default=0), 1)
    if wide * wide * max(x.shape[1], 1) < 1 << 62:
        exact = n * x - sums.astype(np.int64)
        return exact / n, (exact * exact).sum(1).tolist()
    exact = n * x.astype(object) - sums
    return (exact / n).astype(float), (exact * exact).sum(1).tolist()


def fit(vectors: DataFrame, vector_col: str = "embedding", scale: int = SCALE, most: int = COMPONENTS) -> Whitening | None:
    """Learn the whitening from each different vector once; None if there is no vector.

    Vectors with null or infinite entries don't count. Shorter vectors count as filled up with zeros. Entries
    beyond the range of a long are its ends. Components without variance, to double precision, are left out,
    as they can't be whitened.
    """
    rows = vectors.select(entries(F.col(vector_col), scale).alias("x")).where("x IS NOT NULL")
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return None
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    different = stored(rows.select(F.when(F.size("x") == dims, F.col("x")).otherwise(filled).alias("x")).distinct())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, [0] * dims
        for batch in batches:
            x = _matrix(batch["x"], dims)
            count += len(x)
            safe = len(x) * int(np.abs(x.astype(float)).max(initial=0)) < 1 << 62
            sums = [a + b for a, b in zip(sums, (x if safe else x.astype(object)).sum(0).tolist())]
        # Place -1 is the count.
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims), pa.int32()), pa.array([str(s) for s in (count, *sums)])], ["place", "total"]
        )

    partial = different.mapInArrow(summed, "place int, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = {row.place: int(row.total) for row in partial.groupBy("place").agg(total).collect()}
    n = found.pop(-1)
    sums = tuple(found[i] for i in range(dims))

    covariance = _products(different, n, sums, np.eye(dims))
    values, directions = components(covariance, most)
    has_variance = values > dims * _EPS * max(float(np.trace(covariance)), 0.0)
    values, directions = values[has_variance], directions[has_variance]
    whitened = _products(different, n, sums, (directions / np.sqrt(values)[:, None]).T)
    error = float(np.abs(whitened - np.eye(len(values))).max(initial=0.0))
    return Whitening(n, sums, values, directions, float(np.trace(covariance)), error)


def _products(different: DataFrame, n: int, sums: tuple[int, ...], projection: np.ndarray) -> np.ndarray:
    """Mean over all vectors of the products of entries, after centring and projection."""
    dims, k = projection.shape
    exact = np.array(sums, object)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            centred = _deviations(_matrix(batch["x"], dims), n, exact)[0] @ projection
            total += centred.T @ centred
        places = np.arange(k * k, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total.ravel())], ["place", "total"])

    partial = different.mapInArrow(multiplied, "place int, total double")
    found = partial.groupBy("place").agg(F.sum("total").alias("total")).collect()
    result = np.zeros(k * k)
    for place, total in found:
        result[place] = total / n
    result = result.reshape(k, k)
    return (result + result.T) / 2


WHITENED = (
    "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whiten(
    vectors: DataFrame,
    model: Whitening | None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of all usable vectors.

    Rows whose vector is null or holds null or infinite entries are left out; others stay, repeated ones and
    those without an id too. ``deviation`` is the exact sum over dimensions of (n * x - sum)^2, null where that
    has over 38 digits. ``explained`` is the component's part of all variance, and ``identity_error`` the largest
    entry of the whitened fit list's covariance less the identity. There are no rows if the fit found no vector
    or no variance. Vectors of the fit's length or less are expected: longer ones are left out.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), entries(F.col(vector_col), scale).alias("x"))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, {WHITENED}"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    dims, k = len(model.sums), len(model.values)
    projection = (model.vectors / np.sqrt(model.values)[:, None]).T
    exact, limit = np.array(model.sums, object), 10**38

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred, deviation = _deviations(_matrix(batch["x"], dims), model.n, exact)
            m = len(centred)
            digits = [str(d) if d < limit else None for d in deviation]
            each = np.repeat(np.arange(m), k)
            part = np.tile(np.arange(k), m)
            columns = [
                batch["vec_id"].take(pa.array(each)),
                pa.array((part + 1).astype(np.int32)),
                pa.array(np.full(m * k, model.n)),
                pa.array(digits, pa.string()).cast(pa.decimal128(38, 0)).take(pa.array(each)),
                pa.array((centred @ projection).ravel()),
                pa.array((model.values / model.total)[part]),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            names = "vec_id component n deviation whitened explained identity_error".split()
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.where(F.col("x").isNotNull() & (F.size("x") <= dims)).mapInArrow(whitened, schema)
