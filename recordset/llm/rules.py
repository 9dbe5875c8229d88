"""Quality rules: counted statistics with fixed limits, and a calibrated logistic regression over hashed n-grams.

The statistics follow from the words, lines and three-word windows of the
whole text. The model is a logistic regression over indicators of word
unigrams and bigrams and of three- and five-byte strings, hashed to 2**18
columns and scaled by one over the square root of their number. It is trained by
stochastic gradient steps on a bounded sample of rows labelled for quality,
calibrated on rows it had not seen, and applied to Arrow batches. A text is
kept when no base limit fails and its probability reaches ``MIN_PROBABILITY``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from recordset.llm.frames import fit_in_task, labelled_sample, map_text
from recordset.llm.quality import BITS, logistic_curve, text_columns
from recordset.llm.textvec import SPACE, U64, Chunk, chunks, mix, sequence_hash, windows

TRAIN_ROWS = 5000
# Fixed limits of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_PROBABILITY = 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
GRAMS = (3, 5)

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def duplicate_lines(c: Chunk, n_words_before: np.ndarray) -> np.ndarray:
    """Per text, the lines holding a word that equal an earlier line of the text."""
    cut = np.zeros(len(c.buf) + 1, bool)
    cut[1:] = c.buf == 0x0A
    cut[c.offsets] = True
    s = np.flatnonzero(cut[:-1])
    e = np.concatenate([s[1:], [len(c.buf)]]) if len(s) else s
    e = e - ((e > s) & (c.buf[np.maximum(e - 1, 0)] == 0x0A)) if len(s) else e  # without the line end
    word = n_words_before[e] > n_words_before[s]
    s, e = s[word], e[word]
    text = c.text_of(s)
    key = mix(c.hash(s, e) ^ mix(text.astype(U64))) if len(s) else np.zeros(0, U64)
    _, at = np.unique(key, return_index=True)
    first = np.zeros(len(s), bool)
    first[at] = True
    return np.bincount(text[~first], minlength=c.n)


def text_stats(col: pa.Array) -> list[np.ndarray]:
    """The columns of ``STATS`` for each text; a null text has no words."""
    out = [[] for _ in STATS]
    for c in chunks(col):
        s, e, first = c.words(SPACE)
        n_words = np.diff(first)
        space = SPACE[c.buf]
        h = c.hash(s, e)
        text, b, en = windows(first, 3, short=False)
        key = mix(sequence_hash(h, b, en) ^ mix(text.astype(U64)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        again = b[count[inverse] > 1] if len(key) else b
        edge = np.zeros(len(h) + 4, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + 3, -1)
        repeated = np.cumsum(edge)[:len(h)] > 0
        begun = np.zeros(len(c.buf) + 1, np.int64)  # non-space bytes before each position
        np.cumsum(~space, out=begun[1:])
        cols = (n_words, _per_text(~space & ((c.buf & 0xC0) != 0x80), c.offsets), _per_text(SYMBOL[c.buf], c.offsets),
                duplicate_lines(c, begun), _per_text(repeated, first))
        for o, v in zip(out, cols):
            o.append(v.astype(np.int64))
    return [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]


def fit_logistic(rows: list[np.ndarray], y: np.ndarray, epochs: int = 6, rate: float = 1.0, decay: float = 1e-4, seed: int = 3) -> tuple[np.ndarray, float]:
    """Logistic loss by stochastic steps of falling size, the weights of the last half averaged."""
    w, bias = np.zeros(1 << BITS), 0.0
    mean, mean_bias, taken = np.zeros(1 << BITS), 0.0, 0
    rng, t = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        for i in rng.permutation(len(rows)):
            x = 1 / np.sqrt(max(len(rows[i]), 1))
            z = w[rows[i]].sum() * x + bias
            g = y[i] - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            step = rate / (1 + decay * t)
            w[rows[i]] += step * g * x
            bias += 0.1 * step * g
            t += 1
        if epoch >= epochs // 2:
            mean, mean_bias, taken = mean + w, mean_bias + bias, taken + 1
    return mean / max(taken, 1), mean_bias / max(taken, 1)


def _margins(rows, w: np.ndarray, bias: float) -> np.ndarray:
    return np.array([w[ids].sum() / np.sqrt(max(len(ids), 1)) + bias for ids in rows])


def fit_rule_model(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None, max_rows: int = TRAIN_ROWS) -> dict:
    """Fit on at most about ``max_rows`` labelled rows (class-balanced, by a hash of the id), in one executor task.

    Without rows of both classes the model says 1 for every text, and only the base limits decide.
    """
    sample = labelled_sample(docs, labels, label, max_rows, keep)
    feats = map_text(sample, "text", lambda: lambda col: [[x.tobytes() for x in text_columns(col, GRAMS)]], [T.StructField("cols", T.BinaryType())])

    def fit(batches: Iterator[pa.RecordBatch]) -> bytes:
        t = [b for b in batches if b.num_rows]
        raw = [x for b in t for x in b.column("cols").to_pylist()]
        order = sorted(range(len(raw)), key=raw.__getitem__)  # the fit must not depend on the order of arrival
        rows = [np.frombuffer(raw[i], np.int32) for i in order]
        y, weight, fold = (np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in t])[order] if t else np.zeros(0) for n in ("y", "weight", "fold"))
        if not len(rows) or y.min() == y.max():
            return pickle.dumps({"w": np.zeros(1 << BITS, np.float32), "bias": 0.0, "slope": 0.0, "shift": 7.0})
        margin = np.zeros(len(rows))
        for k in (0, 1):
            train, other = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(train) and len(other):
                margin[other] = _margins([rows[i] for i in other], *fit_logistic([rows[i] for i in train], y[train]))
        slope, shift = logistic_curve(margin, y, weight)
        w, bias = fit_logistic(rows, y)
        return pickle.dumps({"w": w.astype(np.float32), "bias": bias, "slope": max(slope, 0.0), "shift": shift})

    return pickle.loads(fit_in_task(feats.select("cols", "y", "weight", "fold"), fit))


def apply_rules(docs: DataFrame, model: dict, text: str = "text", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``quality_probability`` and ``kept``, for every whole text.

    A null text counts as empty; a text without words fails the base limits. Repeated rows are judged alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def judge(col: pa.Array) -> list:
            stats = text_stats(col)
            n_words, repeat = stats[0], stats[4]
            failed = (n_words < min_words) | (100 * repeat > max_repeat_percent * n_words)
            z = m["slope"] * _margins(text_columns(col, GRAMS), m["w"], m["bias"]) + m["shift"]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return [*stats, failed, p, ~failed & (p >= min_probability)]

        return judge

    fields = [T.StructField(n, T.LongType()) for n in STATS]
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("quality_probability", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return map_text(docs, text, make, fields)
