"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all benchmark items.

Normalising folds A-Z and takes words of digits, letters and non-ASCII
characters. The automaton holds every window of ``WINDOW`` words of every item (a shorter item is one window). It
reads words, not letters: a word of the benchmark is a pair of symbols out of two alphabets, each as large as the square
root of the vocabulary, and any other word is one pair that no window has. So a window takes 20 states at most, no state has
more arcs than an alphabet has symbols, and a match can only begin and end between words. Each text is scanned once; the places
of hit words in the original text follow from the word boundaries found there.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm.frames import map_text
from recordset.llm.textvec import LOWER, NOT_ALNUM, chunks

WINDOW = 10
# Benchmark text one automaton may hold. More text is scanned in as many passes as it takes.
AUTOMATON_BYTES = 8 << 20
# States it may have, by an upper bound; measured, a state takes 47 bytes of a Python worker, so these some 470 MB.
AUTOMATON_STATES = 10_000_000
UNKNOWN = "\0\0"
# Words as ``normal_words`` finds them.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

NORMAL = bytes(0x20 if NOT_ALNUM[LOWER[b]] else int(LOWER[b]) for b in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Windows:
    """The automaton over the windows of (id, text) items, and which items have each window."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        own = [(item, normal_words((text or "").encode())) for item, text in items]
        count = Counter(w for _, words in own for w in words)
        side = max(1, math.isqrt(max(len(count) - 1, 0)) + 1)
        # Frequent words first: they take the arcs that are tried first.
        self.code = {w: chr(1 + i // side) + chr(1 + side + i % side) for i, (w, _) in enumerate(count.most_common())}
        self.length = array("H" if window < 1 << 16 else "L")  # words of a window
        self.first = array("L")  # an item that has it
        self.more: dict[int, set[str]] = {}  # and the others, where there are any
        self.names = [item for item, _ in own]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, (item, words) in enumerate(own):
            text, k = self.encode(words), min(window, len(words))
            for i in range(len(words) - k + 1 if k else 0):
                pattern = text[2 * i:2 * (i + k)]
                p = self.automaton.get(pattern, -1)
                if p < 0:
                    self.automaton.add_word(pattern, len(self.first))
                    self.length.append(k)
                    self.first.append(n)
                elif self.names[self.first[p]] != item:
                    self.more.setdefault(p, set()).add(item)
        if self.first:
            self.automaton.make_automaton()

    def encode(self, words: list[bytes]) -> str:
        code = self.code
        return "".join([code.get(w, UNKNOWN) for w in words])

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(first word, end) of every occurrence of a window, and the items that have one of them."""
        hits, ids = [], set()
        if self.first and words:
            for e, p in self.automaton.iter(self.encode(words)):
                j = e // 2 + 1
                hits.append((j - self.length[p], j))
                ids.add(self.names[self.first[p]])
                if p in self.more:
                    ids |= self.more[p]
        return hits, ids


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(docs: DataFrame, text: str, items: list[tuple], window: int) -> DataFrame:
    # A Python worker keeps what was broadcast, and with it the automaton, from task to task.
    shared = docs.sparkSession.sparkContext.broadcast({"items": items})
    also = ("_word_spans", "_item_ids") if "_item_ids" in docs.columns else ()

    def make():
        held = shared.value
        if "windows" not in held:
            held["windows"] = Windows(held["items"], window)
        windows = held["windows"]

        def scan(col: pa.Array, *before: pa.Array) -> list:
            n_words, spans, found = [], [], []
            old = list(zip(*(b.to_pylist() for b in before))) if before else None
            for c in chunks(col):
                for i in range(c.n):
                    words = normal_words(c.buf[c.offsets[i]:c.offsets[i + 1]].tobytes())
                    hits, ids = windows.find(words)
                    if old is not None:
                        at = len(n_words)
                        hits += [(s["first"], s["end"]) for s in old[at][0]]
                        ids.update(old[at][1])
                    n_words.append(len(words))
                    spans.append([{"first": a, "end": b} for a, b in _merge(hits)])
                    found.append(sorted(ids))
            return [n_words, spans, found]

        return scan

    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
    return map_text(docs, text, make, [T.StructField("n_words", T.LongType()), T.StructField("_word_spans", T.ArrayType(span)),
                                       T.StructField("_item_ids", T.ArrayType(T.StringType()))], also)


def _places(col: pa.Array, spans: pa.Array) -> list:
    """Word spans as character places in the original text, with the derived columns."""
    out, n_hit, n_items = [], [], []
    old = spans.to_pylist()
    for c in chunks(col, lower=True):
        s, e, first = c.words(NOT_ALNUM)
        for i in range(c.n):
            own, lo = old[len(out)], c.offsets[i]
            if not own:
                out.append([])
                continue
            chars = np.concatenate([[0], np.cumsum((c.raw[lo:c.offsets[i + 1]] & 0xC0) != 0x80)])
            out.append([{"start": int(chars[s[first[i] + x["first"]] - lo]), "end": int(chars[e[first[i] + x["end"] - 1] - lo])} for x in own])
    return [out]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES,
                  spans: bool = True, automaton_states: int = AUTOMATON_STATES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids, contaminated and hit_spans (character places in the original).

    The items are brought to the driver in parts of at most about ``automaton_bytes`` of text and ``automaton_states`` of states (an item
    beyond that is a part of its own); with more than one part the texts are scanned once for each, from a checkpoint
    between. Null and empty texts have no words and no hits; items without an id or words hit nothing; repeated
    items count once; without items nothing is contaminated. Repeated documents are judged alike. Other columns stay, whatever their
    names; one named like a new column is replaced by it.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text")).filter(
        F.col("item").isNotNull() & F.col("text").isNotNull()).distinct()
    n = F.regexp_count("text", F.lit(WORD)).cast("long")
    states = F.greatest(n - window + 1, F.lit(1)) * F.least(n, F.lit(window)) * 2
    total, most = (x or 0 for x in items.agg(F.sum(F.octet_length("text")), F.sum(states)).first())
    # Parts are cut by a hash of the items, so some are larger than the average.
    parts = max(1, math.ceil(2 * total / automaton_bytes) if total > automaton_bytes else 1,
                math.ceil(1.25 * most / automaton_states) if most > automaton_states else 1)
    own_text = f"_own{docs.columns.index(text)}"
    df = docs.toDF(*(f"_own{i}" for i in range(len(docs.columns))))
    for p in range(parts):
        own = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == p)
        df = _scan(df if p == 0 else df.checkpoint(), own_text, sorted((r["item"], r["text"]) for r in own.collect()), window)
    df = df.withColumn("n_hit", F.coalesce(F.aggregate("_word_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"]), F.lit(0).cast("long")))
    df = df.withColumn("n_items", F.size("_item_ids").cast("long")).withColumn("contaminated", F.col("n_hit") > 0)
    df = df.withColumn("item_ids", F.col("_item_ids"))
    new = ["n_words", "n_hit", "n_items", "contaminated", "item_ids"]
    if spans:
        place = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
        df = map_text(df, own_text, lambda: _places, [T.StructField("hit_spans", T.ArrayType(place))], ("_word_spans",))
        new.append("hit_spans")
    return df.select(*(F.col(f"_own{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in new), *new)
