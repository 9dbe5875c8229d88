"""Toxicity: class-conditional Kneser-Ney models with shared backoff counts.

Texts are folded to lower-case words joined by single spaces. For class k the
probability of a byte after its context is the discounted count of the
six-byte string, then continuation counts of the four- and two-byte strings
it ends with (distinct longer strings met in the class), and at last counts shared by both classes. Strings rather
than whole words are counted, so inflected forms of an expression share their
evidence; discounts above one return the mass of strings met a few times to the
shared end of the chain, where both classes agree. The log-likelihood ratio is
summed for each word and normalised by length, over the whole text and over its most toxic stretch of ``STRETCH`` words, since
a few toxic words must not drown in a long text. A logistic curve over these,
fitted on texts the models had not seen and weighted back to the true class
shares, gives the score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from recordset.llm.frames import fit_in_task, labelled_sample, map_text
from recordset.llm.textvec import LOWER, NOT_ALNUM, U64, chunks, mix, windows

TRAIN_ROWS = 6000
THRESHOLD = 0.5
ORDERS = (6, 4, 2)
DISCOUNT = 2.0
STRETCH = 8
# What the log ratio of a word exceeds these by is summed up.
STRONG = (2.0, 4.0)
N_FEATURES = 5
FOLDED = np.where(NOT_ALNUM[LOWER], np.uint8(0x20), LOWER).astype(np.uint8)
FIT_CHUNK = 4 << 20


class Folded:
    """Folded texts back to back, and for each byte its place within its text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        b = FOLDED[buf]
        gap = b == 0x20
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        starts = offsets[:-1][offsets[:-1] < offsets[1:]]
        keep[starts] = True
        at = np.concatenate([[0], np.cumsum(keep)])
        self.offsets = at[offsets]
        self.buf = b[keep]
        self.place = np.arange(len(self.buf)) - np.repeat(self.offsets[:-1], np.diff(self.offsets))

    def strings(self) -> dict[int, np.ndarray]:
        """For each order n the n bytes ending at each place, packed; spaces stand before the text."""
        out, key = {}, self.buf.astype(U64)
        for j in range(1, max(ORDERS)):
            before = np.full(len(self.buf), 0x20, np.uint8)
            before[j:] = np.where(self.place[j:] >= j, self.buf[:-j], 0x20) if j < len(self.buf) else before[j:]
            key = key | (before.astype(U64) << U64(8 * j))
            if j + 1 in ORDERS:
                out[j + 1] = key
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end with the space that follows, first word of each text)."""
        word = self.buf != 0x20
        begin = word.copy()
        begin[1:] &= ~word[:-1] | (self.place[1:] == 0)
        last = word.copy()
        last[:-1] &= ~word[1:] | (self.place[1:] == 0)
        s, e = np.flatnonzero(begin), np.flatnonzero(last) + 1
        inside = e < len(self.buf)
        e[inside] += (self.buf[e[inside]] == 0x20) & (self.place[e[inside]] != 0)
        return s, e, np.searchsorted(s, self.offsets)


def _context(key: np.ndarray, order: int) -> np.ndarray:
    """The string without its last byte, marked with its length."""
    return (key >> U64(8)) | U64(order << 56)


def build_slots(keys: np.ndarray, values: np.ndarray, absent: float) -> tuple:
    """Values of distinct 64-bit keys in an open table, two to four slots a key; every key reads back its own value.

    A key lies at the first free slot from its hash on, guarded by a 32-bit check. Should two checks agree where one key's search passes the
    other, the table is built again with another hash.
    """
    bits = max((2 * len(keys)).bit_length(), 8)
    salt = 0
    while True:
        check, value = np.zeros(1 << bits, np.uint32), np.full((1 << bits, 2), absent, np.float32)
        at, mark = _slot_and_check(keys, salt, bits)
        left = np.arange(len(keys))
        while len(left):
            free = check[at[left]] == 0
            # Of the keys that want one free slot the first takes it; the others go on to the next slot.
            slot, first = np.unique(at[left[free]], return_index=True)
            placed = left[free][first]
            check[slot], value[slot] = mark[placed], values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            at[left] = np.where(check[at[left]] != 0, (at[left] + 1) & ((1 << bits) - 1), at[left])
        table = (check, value, absent, salt)
        if (read_slots(table, keys) == values.astype(np.float32)).all():
            return table
        salt += 1


def _slot_and_check(keys: np.ndarray, salt: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys + U64(salt))
    return (h >> U64(64 - bits)).astype(np.int64), h.astype(np.uint32) | np.uint32(1)


def read_slots(slots: tuple, keys: np.ndarray) -> np.ndarray:
    check, value, absent, salt = slots
    at, want = _slot_and_check(keys, salt, len(check).bit_length() - 1)
    got = check[at]
    out = value[at]
    out[got != want] = absent
    on = np.flatnonzero((got != want) & (got != 0))
    at, want = at[on], want[on]
    while len(on):
        at = (at + 1) & (len(check) - 1)
        got = check[at]
        held = got == want
        out[on[held]] = value[at[held]]
        further = ~held & (got != 0)
        on, at, want = on[further], at[further], want[further]
    return out


def _count(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of the highest order and their counts over folded texts."""
    keys, counts, i = np.zeros(0, U64), np.zeros(0, np.int64), 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= FIT_CHUNK):
            size += len(texts[j])
            j += 1
        f = Folded(np.concatenate(texts[i:j]), np.concatenate([[0], np.cumsum([len(t) for t in texts[i:j]])]).astype(np.int64))
        k, c = np.unique(f.strings()[ORDERS[0]], return_counts=True) if len(f.buf) else (keys[:0], counts[:0])
        both = np.concatenate([keys, k])
        keys, inverse = np.unique(both, return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([counts, c]), minlength=len(keys)).astype(np.int64)
        i = j
    return keys, counts


def fit_models(texts: list[np.ndarray], y: np.ndarray) -> dict:
    """The two smoothed models: for each order the discounted shares and the mass left to the shorter string."""
    per = [_count([t for t, label in zip(texts, y) if label == k]) for k in (0, 1)]
    model = {"parts": [], "lam": []}
    for n in ORDERS:
        keys = np.union1d(per[0][0], per[1][0])
        count = np.zeros((len(keys), 2))
        for k in (0, 1):
            count[np.searchsorted(keys, per[k][0]), k] = per[k][1]
        ctx, at = np.unique(_context(keys, n), return_inverse=True)
        part, left = np.zeros_like(count), np.ones((len(ctx), 2))
        kept = count.max(axis=1) > DISCOUNT if len(keys) else np.zeros(0, bool)
        for k in (0, 1):
            total = np.bincount(at, weights=count[:, k], minlength=len(ctx))
            part[:, k] = np.maximum(count[:, k] - DISCOUNT, 0) / np.maximum(total[at], 1) if len(keys) else 0
        slots = build_slots(keys[kept], part[kept], 0.0)
        for k in (0, 1):
            left[:, k] -= np.bincount(at, weights=part[:, k], minlength=len(ctx))
        some = left.min(axis=1) < 1 if len(ctx) else np.zeros(0, bool)
        model["parts"].append(slots)
        model["lam"].append(build_slots(ctx[some], left[some], 1.0))
        # continuation counts: distinct strings of this order that end with the next shorter one
        short = ORDERS[ORDERS.index(n) + 1] if n != ORDERS[-1] else 1
        per = [np.unique(k & U64((1 << (8 * short)) - 1), return_counts=True) for k, _ in per]
    shared = np.full(256, 0.5)
    for k, c in per:
        np.add.at(shared, k.astype(np.int64), c)
    model["shared"] = (shared / shared.sum()).astype(np.float32)
    return model


def byte_ratio(m: dict, f: Folded) -> np.ndarray:
    """log p_toxic - log p_ordinary of each byte after its context."""
    p = np.repeat(m["shared"][f.buf][:, None], 2, axis=1)
    strings = f.strings()
    for n, parts, lam in reversed(list(zip(ORDERS, m["parts"], m["lam"]))):
        p = read_slots(parts, strings[n]) + read_slots(lam, _context(strings[n], n)) * p
    p = np.log(np.maximum(p, 1e-12))
    return (p[:, 1] - p[:, 0]).astype(np.float64)


def text_features(m: dict, f: Folded) -> np.ndarray:
    """Per text: mean ratio of a word, of the worst stretch and the worst word, log of 1 + what the words exceed either limit by; zeros without words."""
    s, e, first = f.words()
    total = np.concatenate([[0], np.cumsum(byte_ratio(m, f))]) if len(f.buf) else np.zeros(1)
    ratio = total[e] - total[s]
    out = np.zeros((len(first) - 1, N_FEATURES))
    n_words = np.diff(first)
    some = n_words > 0
    total = np.concatenate([[0], np.cumsum(ratio)])
    out[:, 0] = (total[first[1:]] - total[first[:-1]]) / np.maximum(n_words, 1)
    text, b, e = windows(first, STRETCH)
    if len(b):
        out[some, 1] = np.maximum.reduceat((total[e] - total[b]) / (e - b), np.searchsorted(text, np.flatnonzero(some)))
        out[some, 2] = np.maximum.reduceat(ratio, first[:-1][some])
    for j, limit in enumerate(STRONG):
        strong = np.concatenate([[0], np.cumsum(np.maximum(ratio - limit, 0))])
        out[:, 3 + j] = np.log1p(np.maximum(strong[first[1:]] - strong[first[:-1]], 0))
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small penalty; the last coefficient is the shift."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = weight / weight.mean()
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + 0.1 * beta
        s = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * s[:, None]).T @ x + 0.1 * np.eye(len(beta)), g)
        beta = beta - step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def features_of(m: dict, texts: list[np.ndarray]) -> np.ndarray:
    out = [text_features(m, Folded(t, np.array([0, len(t)]))) for t in texts]
    return np.concatenate(out) if out else np.zeros((0, N_FEATURES))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: Column | None = None, max_rows: int = TRAIN_ROWS) -> dict:
    """Fit on at most about ``max_rows`` labelled rows (class-balanced, by a hash of the id), in one executor task.

    Repeated texts teach once. Without rows of both classes every text gets the known share as its score.
    """
    sample = labelled_sample(docs, labels, label, max_rows, keep)

    def fit(batches: Iterator[pa.RecordBatch]) -> bytes:
        rows: dict[bytes, tuple] = {}
        for b in batches:
            for text, *rest in zip(*(b.column(n).to_pylist() for n in ("text", "y", "weight", "fold"))):
                own = (text or "").encode()
                rows[own] = max(rows.get(own, (-1,)), tuple(rest))
        order = sorted(rows)  # the fit must not depend on the order of arrival
        texts = [np.frombuffer(t, np.uint8) for t in order]
        y, weight, fold = np.array([rows[t] for t in order]).reshape(-1, 3).T
        y = y.astype(int)
        if not len(y) or y.min() == y.max():
            share = float((y * weight).sum() / weight.sum()) if len(y) else 0.0
            shift = float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -7, 7))
            return pickle.dumps(fit_models([], y) | {"beta": np.array([0.0] * N_FEATURES + [shift])})
        x, seen = np.zeros((len(y), N_FEATURES)), np.zeros(len(y), bool)
        for k in (0, 1):
            train, other = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(other) and len(train) and y[train].min() != y[train].max():
                m = fit_models([texts[i] for i in train], y[train])
                x[other], seen[other] = features_of(m, [texts[i] for i in other]), True
        model = fit_models(texts, y)
        if not seen.any() or y[seen].min() == y[seen].max():  # too few rows to set any aside
            x, seen = features_of(model, texts), np.ones(len(y), bool)
        return pickle.dumps(model | {"beta": fit_curve(x[seen], y[seen], weight[seen])})

    return pickle.loads(fit_in_task(sample.select("text", "y", "weight", "fold"), fit))


def score_toxicity(docs: DataFrame, model: dict, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` in 0..1 (higher: toxic likelier), ``predicted`` (1 from ``threshold`` on) and ``log_ratio`` per word.

    Every whole text is scored; a null or empty text, or one without words, gets the score of zero features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def score(col: pa.Array) -> list:
            x = [text_features(m, Folded(c.buf, c.offsets)) for c in chunks(col)]
            x = np.concatenate(x) if x else np.zeros((0, N_FEATURES))
            p = 1 / (1 + np.exp(-np.clip(x @ m["beta"][:-1] + m["beta"][-1], -30, 30)))
            return [p, (p >= threshold).astype(np.int32), x[:, 0]]

        return score

    return map_text(docs, text, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("log_ratio", T.DoubleType())])
