"""Language-model scoring with a weighted backoff automaton.

Tokens are the words of the lower-cased text and one end token. Counts cover
all training texts. The automaton's states are the empty history, the start of
a text, and every token that begins a kept bigram; its arcs are the kept
bigrams, and each state has a failure arc to the empty history whose weight is
the mass the discounted bigrams leave over. One left-to-right pass over a text
carries the state: a token with an arc takes the arc's probability, any other
takes the failure weight and its smoothed unigram probability.

A bigram is kept if it occurs ``LEAST`` times, whatever the size of the corpus. The
frequent part of the automaton is broadcast: tokens and bigrams of at least
``BROADCAST_SHARE`` of all training tokens, of which at most 1 / BROADCAST_SHARE each exist.
The rest is a table of corrections that is joined: where the pass meets a token or an arc
that was not broadcast, it goes on as if the token were unknown, or the arc
missing, and leaves the hash. The correction of a token has its unigram probability and its failure weight, that
of an arc what it has above the failure arc. They are summands of the text's
score, so the sum is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm.frames import arrow_type, map_text
from recordset.llm.textvec import SPACE, U64, Chunk, chunks, mix

# Occurrences that a bigram of the model needs.
LEAST = 2
BROADCAST_SHARE = 1e-7
DISCOUNT = 0.75
END = np.uint64(0xE17A1465D2A3B0F1)  # stands for the hash of the end token
START = np.uint64(0x5B9D3C07A4F6E825)  # the state at the start of a text
# Distinct keys a counting task gathers before it hands them on.
FLUSH_KEYS = 2_000_000
FLUSH_PAIRS = 600_000
# Slots of the bitmap of rare arcs: 16 MB at any input size. It spares lookups; what a shared slot lets through finds nothing in the join.
ARC_SLOTS = 1 << 27


def tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, first token of each text): the words of a text, then the end token."""
    s, e, first = c.words(SPACE)
    out = np.insert(c.hash(s, e), first[1:], END)
    return out, first + np.arange(len(first))


class Tally:
    """Distinct keys and their counts, merged chunk by chunk."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray) -> None:
        k, c = np.unique(keys, return_counts=True)
        self.parts.append((k, c))
        self.size += len(k)
        if self.size > FLUSH_KEYS:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            k, inverse = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
            c = np.bincount(inverse, weights=np.concatenate([p[1] for p in self.parts]), minlength=len(k)).astype(np.int64)
            self.parts = [(k, c)]
        self.size = sum(len(p[0]) for p in self.parts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for k, c in self.parts:
            for i in range(0, len(k), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[i:i + 200_000].view(np.int64)), pa.array(c[i:i + 200_000], pa.int64())], names=["key", "c"])
        self.parts, self.size = [], 0


def _counted(docs: DataFrame, text: str, make) -> DataFrame:
    """Counts of the keys that ``make()(chunk)`` gives, summed over all texts after a sum within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, tally = make(), Tally()
        for b in batches:
            for c in chunks(b.column(0), lower=True):
                tally.add(keys(c))
                if tally.size > FLUSH_KEYS:  # even after merging
                    yield from tally.batches()
        yield from tally.batches()

    return docs.select(text).mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _history(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hash of the state before each token."""
    prev = np.empty(len(h), np.uint64)
    prev[1:] = h[:-1]
    prev[first[:-1]] = START
    return prev


def pair_keys(prev: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(mix(prev) ^ h)


def _counted_pairs(docs: DataFrame, text: str) -> DataFrame:
    """(h, x, c): how often token x follows state h, over all texts after a sum within each task."""

    def merged(parts: list) -> list:
        key, prev, h, c = (np.concatenate(x) for x in zip(*parts))
        _, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        return [(key[at], prev[at], h[at], np.bincount(inverse, weights=c, minlength=len(at)).astype(np.int64))]

    def rows(parts: list) -> Iterator[pa.RecordBatch]:
        for _, *columns in merged(parts) if parts else []:
            for i in range(0, len(columns[0]), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 200_000].view(np.int64)) for x in columns], names=["h", "x", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            for c in chunks(b.column(0), lower=True):
                h, first = tokens(c)
                prev = _history(h, first)
                parts.append((pair_keys(prev, h), prev, h, np.ones(len(h), np.int64)))
                size += len(h)
                if size > FLUSH_PAIRS:
                    parts = merged(parts)
                    size = len(parts[0][0])
                    if size > FLUSH_PAIRS // 2:  # even after merging
                        yield from rows(parts)
                        parts, size = [], 0
        yield from rows(parts)

    return docs.select(text).mapInArrow(run, "h long, x long, c long").groupBy("h", "x").agg(F.sum("c").alias("c"))


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _states(ids: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """The state before each token: the token before it, or the start of a text (every text has its end token)."""
    prev = np.empty(len(ids), np.int64)
    prev[1:] = ids[:-1]
    prev[first[:-1]] = start
    return prev


class LanguageModel:
    """The fitted automaton: its frequent part, which is broadcast, and the corrections for the rest as a table.

    ``vocabulary`` has the sorted hashes of the frequent tokens, ``log_p`` their log10 unigram probabilities,
    ``arcs`` the sorted state << 32 | token of the frequent bigrams, ``arc_log_p`` their log10 probabilities, ``fail``
    the log10 failure weight of each state, ``unknown`` the log10 probability of an unknown token, and ``rare_arcs`` the bitmap of
    the bigrams beside them, or None. ``corrections`` has (key, base, score, known): what a token or a bigram that is not broadcast adds.
    """

    def __init__(self, corrections: DataFrame, n_tokens: int, n_types: int, shared: dict):
        self.corrections, self.n_tokens, self.n_types, self.shared = corrections, n_tokens, n_types, shared


def _long(x: np.uint64) -> int:
    return int(np.array(x).view(np.int64))


def _slots(arcs: DataFrame) -> np.ndarray:
    """The packed bitmap of the slots that the keys of ``arcs`` fall into."""
    slot = (F.col("key").bitwiseAND(F.lit(ARC_SLOTS - 1)) + 1).alias("s")
    parts = arcs.select(slot).groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).toArrow()
    out = np.zeros(ARC_SLOTS // 8, np.uint8)
    for k, m in zip(parts.column("k").to_pylist(), parts.column("m").to_pylist()):
        out[(k - 1) * len(m):k * len(m)] = np.frombuffer(m, np.uint8)
    return out


def in_slots(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & U64(ARC_SLOTS - 1)
    return (slots[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8) & 1).astype(bool)


def fit_language_model(docs: DataFrame, text: str = "text", keep_share: float = 0.0, broadcast_share: float = BROADCAST_SHARE) -> LanguageModel:
    """Count all texts of ``docs`` (null: empty). The counts are written to the checkpoint folder, so a lost executor costs no recount.

    ``keep_share`` prunes the model of a caller who asks for it: bigrams below that share of all tokens are left out.
    ``broadcast_share`` bounds what is broadcast and changes no score.
    """
    spark = docs.sparkSession
    counts = _counted(docs, text, lambda: lambda c: tokens(c)[0]).checkpoint()
    total = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = int(total[0] or 0), int(total[1])
    least = max(LEAST, int(np.ceil(keep_share * n)))
    many = max(least, int(np.ceil(broadcast_share * n)))
    log_p = lambda c: np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    pairs = _counted_pairs(docs, text).filter(F.col("c") >= least).checkpoint()
    gone = pairs.groupBy("h").agg(F.sum(F.col("c") - F.lit(DISCOUNT)).alias("gone")).checkpoint()
    states = counts.join(gone, F.col("key") == F.col("h"), "left").select("key", "c", F.coalesce("gone", F.lit(0.0)).alias("gone"))

    # The frequent part. Any token but the end is followed by one; every text starts and ends once.
    kept = states.filter(F.col("c") >= many).toArrow()
    vocab = kept.column("key").to_numpy().view(np.uint64)
    order = np.argsort(vocab)
    vocab, count = vocab[order], kept.column("c").to_numpy()[order].astype(np.float64)
    starts, start_gone = (t.first() for t in (counts.filter(F.col("key") == _long(END)), gone.filter(F.col("h") == _long(START))))
    follow = np.append(count, float(starts["c"]) if starts else 1.0)
    left = follow - np.append(kept.column("gone").to_numpy()[order], start_gone["gone"] if start_gone else 0.0)
    p = 10 ** log_p(count)
    found = pairs.filter(F.col("c") >= many).toArrow()
    h, x = (found.column(i).to_numpy().view(np.uint64) for i in ("h", "x"))
    state, token = np.where(h == START, len(vocab), _find(vocab, h)), _find(vocab, x)
    arcs = state << 32 | token
    order = np.argsort(arcs)
    arcs, state, token, c = arcs[order], state[order], token[order], found.column("c").to_numpy()[order]
    arc_p = (c - DISCOUNT + left[state] * p[token]) / follow[state] if len(arcs) else np.zeros(0)
    shared = {"vocabulary": vocab, "log_p": np.log10(p), "arcs": arcs, "arc_log_p": np.log10(arc_p), "fail": np.log10(np.maximum(left / follow, 1e-9)),
              "unknown": float(log_p(0)), "rare_arcs": None}

    # The rest.
    scale = F.lit(n + 0.5 * (v + 1))
    rare = states.filter(F.col("c") < many)
    base = F.log10((F.col("c") + 0.5) / scale) - F.lit(shared["unknown"])
    fail = F.log10(F.greatest(1 - F.col("gone") / F.col("c"), F.lit(1e-9)))
    corrections = rare.select("key", base.alias("base"), (base + fail).alias("score"), F.lit(1).alias("known"))
    if many > least:
        spread = spark.sparkContext.broadcast((vocab, count, left))

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """What is known of both ends of a rare arc; an end that is not frequent is left to the joins."""
            vocab, count, left = spread.value
            for b in batches:
                h, x = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
                state, token = np.where(h == START, len(vocab), _find(vocab, h)), _find(vocab, x)
                yield pa.RecordBatch.from_arrays([
                    pa.array(pair_keys(h, x).view(np.int64)), b.column(0), b.column(1), b.column(2),
                    pa.array(left[state], mask=state < 0), pa.array(np.append(count, 0.0)[token], mask=token < 0)], names=["key", "h", "x", "c", "left", "count"])

        known = pairs.filter(F.col("c") < many).mapInArrow(ends, "key long, h long, x long, c long, left double, count double")
        shared["rare_arcs"] = _slots(known)
        whole = F.col("left").isNotNull() & F.col("count").isNotNull()
        above = lambda left, count: F.log10(1 + (F.col("c") - F.lit(DISCOUNT)) * scale / (left * (count + 0.5)))
        corrections = corrections.union(known.filter(whole).select("key", F.lit(0.0), above(F.col("left"), F.col("count")), F.lit(0)))
        known = known.filter(~whole)
        # An end that is known already takes part in the join under a key of no token's, spread over the tasks.
        known = known.withColumn("_h", F.when(F.col("left").isNull(), F.col("h")).otherwise(F.xxhash64("key", F.lit(1))))
        known = known.withColumn("_x", F.when(F.col("count").isNull(), F.col("x")).otherwise(F.xxhash64("key", F.lit(2))))
        known = known.join(rare.select(F.col("key").alias("_h"), (F.col("c") - F.col("gone")).alias("_left")), "_h", "left")
        known = known.join(rare.select(F.col("key").alias("_x"), F.col("c").alias("_count")), "_x", "left")
        both = above(F.coalesce("left", "_left"), F.coalesce("count", "_count"))
        corrections = corrections.union(known.select("key", F.lit(0.0), both, F.lit(0)))
    return LanguageModel(corrections, n, v, shared)


def walk(m: dict, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token ids, base log10, automaton log10, place of the arc) of each token; a token that is not broadcast counts as unknown."""
    ids = _find(m["vocabulary"], h)
    state = _states(ids, first, len(m["vocabulary"]))
    base = np.where(ids >= 0, m["log_p"][ids], m["unknown"]) if len(m["vocabulary"]) else np.full(len(ids), m["unknown"])
    fail = np.where(state >= 0, m["fail"][state], 0.0)
    arc = _find(m["arcs"], np.where((ids >= 0) & (state >= 0), state << 32 | np.maximum(ids, 0), -1))
    score = fail + base
    hit = arc >= 0
    score[hit] = m["arc_log_p"][arc[hit]]
    return ids, base, score, arc


def score_language_model(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability).

    Every whole text is scored; a null or empty text is its end token alone. Without training texts every token
    counts as unknown. Repeated rows are scored alike and all kept.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.shared)

    def make():
        m = shared.value

        def score(col: pa.Array) -> list:
            n_tokens, known, base, total, rare, times = [], [], [], [], [], []
            for c in chunks(col, lower=True):
                h, first = tokens(c)
                ids, b, s, arc = walk(m, h, first)
                at = first[:-1]
                n_tokens.append(np.diff(first))
                known.append(np.add.reduceat((ids >= 0).astype(np.int64), at))
                base.append(np.add.reduceat(b, at))
                total.append(np.add.reduceat(s, at))
                missed = np.flatnonzero(ids < 0)
                keys = h[missed]
                if m["rare_arcs"] is not None:
                    pair = np.flatnonzero(arc < 0)
                    pairs = pair_keys(_history(h, first)[pair], h[pair])
                    held = in_slots(m["rare_arcs"], pairs)
                    missed, keys = np.append(missed, pair[held]), np.append(keys, pairs[held])
                own = np.searchsorted(first, missed, "right") - 1
                order = np.lexsort((keys, own))
                own, keys = own[order], keys[order]
                new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (keys[1:] != keys[:-1]))[:len(keys)])
                cut = np.searchsorted(own[new], np.arange(c.n + 1)).astype(np.int32)
                rare.append(pa.ListArray.from_arrays(cut, keys[new].view(np.int64), type=arrow_type(fields[4].dataType)))
                times.append(pa.ListArray.from_arrays(cut, np.diff(np.append(new, len(keys))).astype(np.int32), type=arrow_type(fields[5].dataType)))
            return [*(np.concatenate(x) for x in (n_tokens, known, base, total)), pa.concat_arrays(rare), pa.concat_arrays(times)]

        return score

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("_known", T.LongType()), T.StructField("_base", T.DoubleType()), T.StructField("_score", T.DoubleType()),
              T.StructField("_rare", T.ArrayType(T.LongType())), T.StructField("_times", T.ArrayType(T.IntegerType()))]
    own = [c for c in docs.columns if c.lower() not in ("n_known", "train_tokens", "base_score", "score", "n_tokens")]
    first = map_text(docs, text, make, fields).withColumn("_row", F.monotonically_increasing_id())
    names = [c for c in own if c != text]
    # One row a distinct missed key of a text, the first with the text's own values. A text without any gets one row whose key, spread by the row number, is that of no token.
    flat = first.select("_row", *names, "n_tokens", "_known", "_base", "_score", F.posexplode_outer(F.arrays_zip("_rare", "_times")).alias("_pos", "_t"))
    head = F.coalesce("_pos", F.lit(0)) == 0
    values = F.when(head, F.struct(*names, "n_tokens", "_known", "_base", "_score")).alias("_own")
    flat = flat.select("_row", values, F.coalesce(F.col("_t._rare"), F.xxhash64("_row")).alias("_key"), F.coalesce(F.col("_t._times"), F.lit(0)).alias("_times"))
    more = model.corrections.select(F.col("key").alias("_key"), F.col("base").alias("_b"), F.col("score").alias("_s"), F.col("known").alias("_k"))
    joined = flat.join(more, "_key", "left").filter(F.col("_k").isNotNull() | F.col("_own").isNotNull())
    add = lambda c: F.coalesce(F.sum(F.col("_times") * F.col(c)), F.lit(0)).alias(f"_add{c}")
    out = joined.groupBy("_row").agg(F.first("_own", ignorenulls=True).alias("_own"), add("_b"), add("_s"), add("_k"))
    return out.select(*(F.col(f"_own.`{c}`") for c in names), "_own.n_tokens", (F.col("_own._known") + F.col("_add_k")).alias("n_known"),
                      F.lit(model.n_tokens).cast("long").alias("train_tokens"), (F.col("_own._base") + F.col("_add_b")).alias("base_score"),
                      (F.col("_own._score") + F.col("_add_s")).alias("score"))


def score_with_language_model(docs: DataFrame, train: Column, text: str = "text") -> DataFrame:
    """Fit on the texts that ``train`` marks and score all."""
    return score_language_model(docs, fit_language_model(docs.filter(train), text), text)
