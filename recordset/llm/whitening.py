"""Whitening of embeddings: principal components of the distributed covariance, corrected from single to double precision.

The covariance is gathered in one pass: each task keeps (count, sums, centred products) of its rows, batch by batch, and these small
states are merged in a tree, so what moves grows with the tasks and the square of the dimension and never with the rows. Products are always of centred
values; integer columns keep exact integer sums.

The eigenvectors start in single precision and are refined by the iteration of Ogita and Aishima: matrix products in double
precision give the residuals R = I - X'X and S = X'AX, from which a correction X(I + E) follows entry by entry; each step doubles the correct digits. Entries of E between
eigenvalues that lie too near each other for this are not trustworthy: such a cluster is solved again as a small problem, A projected on the orthonormalised basis of the
cluster, and goes back into the iteration. The matrix of a few thousand rows at most (``MAX_DIMENSION``) is solved on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DIMENSION = 4096
COMPONENTS = 32
MAX_STEPS = 12
# States one merging task takes.
FAN_IN = 64


def matrix_of(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, rows) for the usable vectors of each length; nulls and entries that are null or not finite make a vector unusable."""
    n = np.asarray(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False), np.int64)
    flat = col.flatten()
    empty = flat.is_null().to_numpy(zero_copy_only=False)
    x = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(n) - n
    bad = np.bincount(np.repeat(np.arange(len(n)), n), weights=empty | ~np.isfinite(x), minlength=len(n)) > 0
    for length in np.unique(n[n > 0]).tolist():
        places = np.flatnonzero((n == length) & ~bad)
        if len(places):
            yield length, places, x[at[places][:, None] + np.arange(length)]


def _state(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(count, sums, products of the values centred at their mean)."""
    sums = x.sum(axis=0)
    y = x - x[0]  # differences of integers are exact, so what follows does not see a large offset
    y = y.astype(np.float64)
    y -= y.mean(axis=0)
    return len(x), sums, y.T @ y


def _merge(a: tuple, b: tuple) -> tuple[int, np.ndarray, np.ndarray]:
    (n, s, p), (m, t, q) = a, b
    d = (n * t - m * s) / (n * m) if n * m < 1 << 20 or s.dtype != np.int64 else _mean_gap(n, s, m, t)
    return n + m, s + t, p + q + np.outer(d, d) * (n * m / (n + m))


def _mean_gap(n: int, s: np.ndarray, m: int, t: np.ndarray) -> np.ndarray:
    """t / m - s / n for integer sums, without the loss of digits that a large common offset would cost."""
    base = s // n
    return (t - m * base) / m - (s - n * base) / n


def _moments(vectors: DataFrame, vec_col: str) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """State of the vectors of each length, merged in a tree of tasks; only the last states reach the driver."""
    exact = isinstance(vectors.schema[vec_col].dataType.elementType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    kind = np.int64 if exact else np.float64
    schema = "length int, n long, sums binary, products binary"

    def rows(found: dict) -> Iterator[pa.RecordBatch]:
        for length, (n, s, p) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([n], pa.int64()), pa.array([s.tobytes()]), pa.array([p.tobytes()])],
                                             names=["length", "n", "sums", "products"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            for length, _, x in matrix_of(b.column(0)):
                if length > MAX_DIMENSION:
                    raise ValueError(f"vectors of {length} entries; at most {MAX_DIMENSION}")
                state = _state(x.astype(kind))
                found[length] = _merge(found[length], state) if length in found else state
        yield from rows(found)

    def unpack(b: pa.RecordBatch) -> Iterator[tuple]:
        for length, n, s, p in zip(*(c.to_pylist() for c in b.columns)):
            yield length, (n, np.frombuffer(s, kind), np.frombuffer(p).reshape(length, length))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for b in batches:
            for length, state in unpack(b):
                found[length] = _merge(found[length], state) if length in found else state
        yield from rows(found)

    states = vectors.select(F.col(f"`{vec_col}`")).mapInArrow(gather, schema)
    width = states.rdd.getNumPartitions()
    while width > 1:
        width = -(-width // FAN_IN)
        states = states.repartition(width).mapInArrow(combine, schema)
    return {length: state for b in states.toArrow().to_batches() for length, state in unpack(b)}


@dataclass(frozen=True)
class Whitening:
    dimension: int
    n: int
    sums: np.ndarray  # exact integers for integer columns
    covariance: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, a column each
    trace: float

    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def refined_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix, to double precision from a start in single precision."""
    size = np.abs(a).max()
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    _, start = np.linalg.eigh(a.astype(np.float32))
    x = start[:, ::-1].astype(np.float64)
    norm = np.linalg.norm(a, 2)
    eye, tiny = np.eye(len(a)), np.finfo(np.float64).eps
    last = np.inf
    for _ in range(MAX_STEPS):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        near = 2 * (np.linalg.norm(s - np.diag(values), 2) + norm * np.linalg.norm(r, 2))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        for lo, hi in _clusters(values, near):
            # The refined basis spans the cluster's space; within it the small projected problem, shifted to the cluster, decides.
            q, _ = np.linalg.qr(x[:, lo:hi])
            shift = values[lo:hi].mean()
            t = q.T @ (a @ q - shift * q)
            _, w = np.linalg.eigh((t + t.T) / 2)
            x[:, lo:hi] = q @ w[:, ::-1]
        change = np.abs(np.where(apart, e, 0)).max()
        if change <= 4 * tiny or change >= last:
            break
        last = change if change < 1e-6 else np.inf
    x /= np.sqrt(np.einsum("ij,ij->j", x, x))
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def _clusters(values: np.ndarray, near: float) -> list[tuple[int, int]]:
    """Stretches of at least two falling eigenvalues, each within ``near`` of the one before."""
    cut = np.flatnonzero(-np.diff(values) > near) + 1
    return [(s, e) for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(values)]) if e - s > 1]


def fit_whitening(vectors: DataFrame, vec_col: str) -> Whitening | None:
    """The whitening of all usable vectors of ``vec_col``, an array of numbers; None when there are none.

    A vector is unusable when it is null, empty or holds null or non-finite entries, or when its length is not that of most usable vectors (of
    equally frequent lengths the smallest counts). Repeated rows count as often as they occur.
    """
    found = _moments(vectors, vec_col)
    if not found:
        return None
    length = min(found, key=lambda k: (-found[k][0], k))
    n, sums, products = found[length]
    covariance = products / n
    values, axes = refined_eigen(covariance)
    return Whitening(length, n, sums, covariance, values, axes, float(np.trace(covariance)))


def rank(model: Whitening) -> int:
    """Components whose eigenvalue is not lost in rounding."""
    return int((model.values > model.dimension * np.finfo(np.float64).eps * max(model.values.max(), 0)).sum()) if model.trace else 0


def whiten(vectors: DataFrame, model: Whitening | None, vec_col: str, k: int = COMPONENTS, out_col: str = "whitened") -> DataFrame:
    """``vectors`` with ``out_col``: the first ``k`` whitened components, as doubles.

    Fewer where the covariance has a smaller rank (constant vectors give none). Null for an unusable vector, and without a model. Rows and other columns stay; a column called ``out_col`` is
    replaced.
    """
    from recordset.llm.frames import map_text

    k = min(k, rank(model)) if model else 0
    field = T.StructField(out_col, T.ArrayType(T.DoubleType()))

    def make():
        if model is None:
            return lambda col: [[None] * len(col)]
        scaled = model.vectors[:, :k] / np.sqrt(model.values[:k])
        exact = model.sums.dtype == np.int64
        base = model.sums // model.n if exact else model.sums / model.n
        rest = (model.sums - model.n * base) / model.n if exact else 0.0

        def project(col: pa.Array) -> list:
            out: list = [None] * len(col)
            for length, places, x in matrix_of(col):
                if length == model.dimension:
                    # The large common part goes in integers, before anything is rounded.
                    for i, row in zip(places.tolist(), ((x - base).astype(np.float64) - rest) @ scaled):
                        out[i] = row
            return [out]

        return project

    return map_text(vectors, vec_col, make, [field])


def identity_error(whitened: DataFrame, out_col: str = "whitened") -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, over all of them; 0 without any."""
    found = _moments(whitened, out_col)
    if not found:
        return 0.0
    length = max(found)
    n, _, products = found[length]
    return float(np.abs(products / n - np.eye(length)).max())
