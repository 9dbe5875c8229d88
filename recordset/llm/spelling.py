"""Spelling variants: words one edit apart, found by pivotal grams.

All bigrams are ordered by rarity over the distinct words. The prefix of a word is its three rarest bigram occurrences (and every further occurrence of the third
one's bigram); two disjoint ones of them, the cheapest by dynamic programming over their places, are its pivots. One edit can touch only one of two
disjoint pivots. So of two words one edit apart, the one whose prefix ends earlier in the order keeps a pivot that stands in the other's prefix, moved by
one place at most.

Only the left pivot with all that stands before it, or the right pivot with all that stands after it, need be looked up: an edit that leaves one of them
whole lies on its other side. What is left on that side is cut in halves, one of which the edit leaves whole as well. An entry of the index is thus (side, length of the rest, the
whole side with its bigram, one half of the rest): places and lengths are part of the key, so a bigram of a large share of all
words is spread over as many keys as there are words' sides. Pairs that meet are verified by their edit distance within the join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm.frames import map_text

LEAST_POINTS = 7
LEAST_COUNT = 2
# A form is at least so many times as frequent as its variant.
DOMINANCE = 10
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of this length and more are looked up by the halves of the whole word; a run of letters may be as long as a text.
LONG = 64


def letter_runs(docs: DataFrame, text: str = "text", id_col: str = "doc_id", least: int = LEAST_POINTS) -> DataFrame:
    """(id, word): every maximal run of letters of at least ``least`` code points in the whole texts, A-Z lower-cased."""
    runs = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"{RUN}{{{least},}}"), 0)).alias("run"))
    return runs.select("id", F.translate("run", UPPER, LOWER).alias("word"))


def misspelled(runs: DataFrame, every: int = 31) -> DataFrame:
    """``runs`` in which one in ``every`` (id, word), by crc32 of "id:word", loses the code point at crc32 modulo the length. A null id counts as ''."""
    code = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    rows = runs.withColumn("_code", code)
    at = (F.col("_code") % F.char_length("word")).cast("int")
    shorter = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    return rows.select("id", F.when(F.col("_code") % every == 0, shorter).otherwise(F.col("word")).alias("word"))


def word_counts(runs: DataFrame, least_points: int = LEAST_POINTS, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of at least ``least_points`` code points that occur at least ``least`` times."""
    return runs.filter(F.char_length("word") >= least_points).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram occurs in the distinct words: at most the square of the alphabet (90 letters) reaches the driver."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = words.filter(F.char_length("word") > 1).select(F.explode(F.transform(places, lambda i: F.substr("word", i, F.lit(2)))).alias("g"))
    return {r["g"]: r["c"] for r in grams.groupBy("g").agg(F.count(F.lit(1)).alias("c")).collect()}


def pivots_of(word: str, rank: dict[str, int], count: dict[str, int]) -> tuple[list[int], int, int]:
    """(places of the prefix, place of the left pivot, of the right one)."""
    ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
    third = sorted(ranks)[2]
    prefix = [i for i, r in enumerate(ranks) if r <= third]
    # Over the places in order: the cheapest first pivot that ends before each place, and the cheapest pair so far.
    pair, left, ready = (float("inf"), 0, 0), None, 0
    for j in prefix:
        while prefix[ready] <= j - 2:
            cost = (count[word[prefix[ready]:prefix[ready] + 2]], prefix[ready])
            left = cost if left is None else min(left, cost)
            ready += 1
        if left is not None:
            pair = min(pair, (left[0] + count[word[j:j + 2]], left[1], j))
    return prefix, pair[1], pair[2]


def with_pivots(words: DataFrame, counts: dict[str, int]) -> DataFrame:
    """Words with the places (from 0) of their prefix bigrams and of their two pivots."""
    rank = {g: i for i, (_, g) in enumerate(sorted((c, g) for g, c in counts.items()))}

    def make() -> Callable:
        def place(col) -> list:
            found = [pivots_of(w, rank, counts) for w in col.to_pylist()]
            return [[f[0] for f in found], [f[1] for f in found], [f[2] for f in found]]

        return place

    place = T.IntegerType()
    return map_text(words, "word", make, [T.StructField("prefix", T.ArrayType(place)), T.StructField("left", place), T.StructField("right", place)])


def _key(side: str, fixed: Column, length: Column, half: str, part: Column) -> Column:
    return F.xxhash64(F.lit(side + half), length.cast("int"), fixed, part)


def _own_halves(side: str, fixed: Column, rest: Column) -> list[Column]:
    """Keys of a rest under its own length: its first half, and what follows."""
    m = F.char_length(rest)
    h = F.floor(m / 2).cast("int")
    return [_key(side, fixed, m, "1", F.substr(rest, F.lit(1), h)), _key(side, fixed, m, "2", F.substr(rest, h + 1))]


def _sought_halves(side: str, fixed: Column, rest: Column) -> list[Column]:
    """Keys under which a rest one edit away is entered, for each length that it can have."""
    n, out = F.char_length(rest), []
    for longer in (-1, 0, 1):
        m = n + longer
        h = F.floor(m / 2).cast("int")
        tail = m - h
        out.append(F.when(m >= 0, _key(side, fixed, m, "1", F.substr(rest, F.lit(1), h))))
        out.append(F.when((m >= 0) & (tail <= n), _key(side, fixed, m, "2", F.substr(rest, n - tail + 1))))
    return out


def _entries(placed: DataFrame, words: DataFrame) -> DataFrame:
    """(key, word): the index over the prefix bigrams of all words."""
    w = F.col("word")
    short = placed.select("word", F.explode("prefix").alias("p"))
    keys = _own_halves("L", F.substr(w, F.lit(1), F.col("p") + 2), F.substr(w, F.col("p") + 3)) + _own_halves("R", F.substr(w, F.col("p") + 1), F.substr(w, F.lit(1), F.col("p")))
    whole = words.filter(F.char_length("word") >= LONG)
    return short.select("word", F.explode(F.array(*keys)).alias("key")).union(whole.select("word", F.explode(F.array(*_own_halves("W", F.lit(""), w))).alias("key")))


def _lookups(placed: DataFrame, words: DataFrame) -> DataFrame:
    """(key, word): where a word one edit away from this one may be entered."""
    w = F.col("word")
    keys = _sought_halves("L", F.substr(w, F.lit(1), F.col("left") + 2), F.substr(w, F.col("left") + 3))
    keys += _sought_halves("R", F.substr(w, F.col("right") + 1), F.substr(w, F.lit(1), F.col("right")))
    whole = words.filter(F.char_length("word") >= LONG)
    found = placed.select("word", F.explode(F.array(*keys)).alias("key")).union(whole.select("word", F.explode(F.array(*_sought_halves("W", F.lit(""), w))).alias("key")))
    return found.filter(F.col("key").isNotNull())


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a before b: the pairs of ``words`` (a column ``word`` of distinct words of 4 code points or more) at an edit distance of exactly one."""
    words = words.select("word")
    short = words.filter(F.char_length("word") <= LONG)
    placed = with_pivots(short, bigram_counts(short)).checkpoint()
    look, entry = _lookups(placed, words).withColumnRenamed("word", "a"), _entries(placed, words).withColumnRenamed("word", "b")
    met = look.join(entry, "key").filter((F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain word, form, form of the form ... ends. Each turn doubles the steps; forms must not run in a circle."""
    at = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        far = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        at = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return at


def group_variants(counts: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row for each row of ``counts`` (word, n; distinct words of 4 code points or more).

    ``n_near`` counts the words at an edit distance of exactly one. ``form`` is the most frequent of them (of equally frequent ones the first in code-point order) if
    it is at least ``dominance`` times as frequent as the word, else null, and ``form_n`` its count; ``root`` is the last word that forms lead to, the word itself without a form.
    An empty table gives no rows.
    """
    counts = counts.select("word", "n").checkpoint()
    pairs = near_pairs(counts).checkpoint()
    near = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    near = near.join(counts.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    rows = counts.join(best, "word", "left")
    other_n = -F.col("best.less")
    dominant = other_n >= dominance * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(dominant, F.col("best.other")).alias("form"),
                       F.when(dominant, other_n).alias("form_n")).checkpoint()
    roots = roots_of(rows.filter(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``group_variants`` of the words of whole texts: runs of letters, of at least ``LEAST_POINTS`` code points and ``LEAST_COUNT`` occurrences.

    A null or empty text has no words; repeated rows count as often as they occur. Other columns are not read.
    """
    return group_variants(word_counts(letter_runs(docs, text, id_col)))
