"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by Naive Bayes log-count ratios.

A text is the set of its word unigrams, word bigrams and four-byte strings,
each hashed to one of 2**18 columns. Column f is scaled by
r[f] = log((p[f] + a) / |p|) - log((q[f] + a) / |q|), where p and q count the
texts of either class that hold f, and the scaled vector is brought to length
one. A linear model with hinge loss is fitted on it by dual coordinate descent.
The margin becomes a probability by a logistic curve fitted on margins of
texts the model had not seen, weighted back to the true class shares.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from recordset.llm.frames import fit_in_task, labelled_sample, map_text
from recordset.llm.textvec import SPACE, U64, chunks, sequence_hash, windows

BITS = 18
# Bound of the labelled rows the model is fitted on, both classes together.
TRAIN_ROWS = 6000
THRESHOLD = 0.7


def gram_columns(h: np.ndarray, seed: int) -> np.ndarray:
    return ((h * U64(2 * seed + 0x9E3779B97F4A7C15)) >> U64(64 - BITS)).astype(np.int32)


def byte_grams(buf: np.ndarray, k: int) -> np.ndarray:
    """The k-byte string starting at each position, packed into an integer; len(buf) - k + 1 of them."""
    n = len(buf) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    g = buf[:n].astype(U64)
    for j in range(1, k):
        g |= buf[j:j + n].astype(U64) << U64(8 * j)
    return g


class Stamp:
    """Distinct column ids of one text after another, without sorting."""

    def __init__(self, bits: int = BITS):
        self.at = np.zeros(1 << bits, np.int32)

    def distinct(self, ids: np.ndarray) -> np.ndarray:
        order = np.arange(len(ids), dtype=np.int32)
        self.at[ids] = order
        return ids[self.at[ids] == order]


def text_columns(col: pa.Array, sizes: tuple[int, ...] = (4,)) -> Iterator[np.ndarray]:
    """Distinct feature columns of each text, in row order; an empty text has none."""
    stamp = Stamp()
    for c in chunks(col):
        s, e, first = c.words(SPACE)
        h = c.hash(s, e)
        uni = gram_columns(h, 1)
        _, b, en = windows(first, 2, short=False)
        bi, bi_first = gram_columns(sequence_hash(h, b, en), 2), np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - 1, 0))])
        grams = [(k, gram_columns(byte_grams(c.buf, k) * U64(0xD6E8FEB86659FD93), 2 + k)) for k in sizes]
        for i in range(c.n):
            parts = [uni[first[i]:first[i + 1]], bi[bi_first[i]:bi_first[i + 1]]]
            lo, hi = c.offsets[i], c.offsets[i + 1]
            parts += [g[lo:max(lo, hi - k + 1)] for k, g in grams]
            yield stamp.distinct(np.concatenate(parts))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray | None = None, alpha: float = 1.0) -> np.ndarray:
    counts = np.full((2, 1 << BITS), alpha)
    for ids, label in zip(rows, y):
        counts[label, ids] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1]) - np.log(counts[0])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, C: float = 1.0, epochs: int = 12, seed: int = 1):
    """Hinge loss with an L2 penalty: one dual variable per row, clipped to [0, C], with a bias column."""
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    sign = np.where(y == 1, 1.0, -1.0)
    norm = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = sign[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            a = min(max(alpha[i] - g / norm[i], 0.0), C)
            step = (a - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = a
        if moved < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of P(1) = 1 / (1 + exp(-slope * margin - shift)), by Newton steps with a small penalty on the slope."""
    a, b = 1.0, 0.0
    weight = weight / weight.mean()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, s = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        g = np.array([(d * margin).sum() + 0.1 * a, d.sum() + 0.01 * b])
        m = np.array([[(s * margin * margin).sum() + 0.1, (s * margin).sum()], [(s * margin).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def scaled(rows: list[np.ndarray], r: np.ndarray) -> list[np.ndarray]:
    return [v / max(np.sqrt(v @ v), 1e-9) for v in (r[ids] for ids in rows)]


def fit_rows(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, fold: np.ndarray) -> dict:
    if len(rows) == 0 or y.min() == y.max():
        share = float((y * weight).sum() / weight.sum()) if len(rows) else 0.5
        return {"w": np.zeros(1 << BITS, np.float32), "r": np.zeros(1 << BITS, np.float32), "bias": 0.0, "slope": 0.0,
                "shift": float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -7, 7))}

    def fit(at: np.ndarray):
        own = [rows[i] for i in at]
        r = log_count_ratio(own, y[at])
        return r, *dual_coordinate_descent(own, scaled(own, r), y[at])

    margin = np.zeros(len(rows))
    for k in (0, 1):
        train, other = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(train) and len(other) and y[train].min() != y[train].max():
            r, w, bias = fit(train)
            margin[other] = [w[rows[i]] @ v + bias for i, v in zip(other, scaled([rows[i] for i in other], r))]
    slope, shift = logistic_curve(margin, y, weight)
    r, w, bias = fit(np.arange(len(rows)))
    return {"w": w.astype(np.float32), "r": r.astype(np.float32), "bias": bias, "slope": max(slope, 0.0), "shift": shift}


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None, max_rows: int = TRAIN_ROWS) -> dict:
    """Fit on at most about ``max_rows`` labelled rows (class-balanced, by a hash of the id), in one executor task."""
    sample = labelled_sample(docs, labels, label, max_rows, keep)
    feats = map_text(sample, "text", lambda: lambda col: [[x.tobytes() for x in text_columns(col)]], [T.StructField("cols", T.BinaryType())])

    def fit(batches: Iterator[pa.RecordBatch]) -> bytes:
        t = [b for b in batches if b.num_rows]
        rows = [np.frombuffer(x, np.int32) for b in t for x in b.column("cols").to_pylist()]
        order = sorted(range(len(rows)), key=lambda i: rows[i].tobytes())  # the fit must not depend on the order of arrival
        col = lambda n: np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in t]) if t else np.zeros(0)
        y, weight, fold = (col(n)[order] for n in ("y", "weight", "fold"))
        return pickle.dumps(fit_rows([rows[i] for i in order], y.astype(int), weight, fold))

    return pickle.loads(fit_in_task(feats.select("cols", "y", "weight", "fold"), fit))


def score_quality(docs: DataFrame, model: dict, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` in 0..1 (higher: quality 1 likelier) and ``predicted`` (1 from ``threshold`` on).

    Every whole text is scored; a null or empty text has no features and gets the score of the bias alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        v, sq = m["w"] * m["r"], m["r"] ** 2

        def score(col: pa.Array) -> list:
            margin = np.array([(v[ids].sum() / max(np.sqrt(sq[ids].sum()), 1e-9) if len(ids) else 0.0) + m["bias"] for ids in text_columns(col)])
            p = 1 / (1 + np.exp(-np.clip(m["slope"] * margin + m["shift"], -30, 30)))
            return [p, (p >= threshold).astype(np.int32)]

        return score

    return map_text(docs, text, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
