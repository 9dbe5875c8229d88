"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import types as T

from recordset.llm import spelling
from recordset.session import ensure_checkpoint_dir
from llm_helpers import LOWER, ODD_TEXTS, docs  # noqa: F401


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i + 1:] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1:]


def brute(counts):
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w, n in counts.items())


def found(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def edited(rng, w, letters):
    i, kind = rng.randrange(len(w)), rng.randrange(3)
    return w[:i] + (rng.choice(letters) if kind else "") + w[i + (kind < 2):]


@pytest.mark.parametrize("seed,letters,lengths", [(1, "abcdefghij", (4, 12)), (2, "ab", (4, 9)), (3, "aàßÿe", (5, 8)), (4, "abc", (60, 68))])
def test_pairs_forms_and_roots_match_brute_force(spark, seed, letters, lengths):
    """Few letters make words with many equal bigrams and ties; long words take the other way of looking up."""
    ensure_checkpoint_dir(spark)
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(60)}
    for _ in range(3):
        words |= {e for w in sorted(words) for e in [edited(rng, w, letters)] if len(e) >= 4 and rng.random() < 0.8}
    counts = {w: rng.choice([2, 3, 3, 20, 30, 300, 3000]) for w in words}
    want = brute(counts)
    assert sum(r[2] for r in want) > len(want) and any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)
    assert found(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == want


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(4, 14)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
        count = {g: rng.randint(1, 9) for g in grams}
        rank = {g: i for i, (_, g) in enumerate(sorted((c, g) for g, c in count.items()))}
        prefix, a, b = spelling.pivots_of(word, rank, count)
        assert a in prefix and b in prefix and b - a >= 2 and len(prefix) >= 3
        assert count[word[a:a + 2]] + count[word[b:b + 2]] == min(count[word[i:i + 2]] + count[word[j:j + 2]] for i in prefix for j in prefix if j - i >= 2)


def query_counts(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def test_whole_texts_with_deletions(spark, docs):  # noqa: F811
    ensure_checkpoint_dir(spark)
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdeéÀÿ") for _ in range(rng.randint(3, 12))) for _ in range(40)]
    texts = [rng.choice([" ", ", ", "\n", "3"]).join(rng.choice(vocabulary).capitalize() for _ in range(200)) for _ in range(40)]
    rows = list(enumerate([*texts, *texts[:3], *ODD_TEXTS, "abcdefgh" * 90_000, "abcdefgh" * 90_000 + "i"])) + [(None, texts[0]), (3, texts[5])]
    rows += [(1000 + k, "ABCDEFGH" * 90_000 + "i") for k in range(3)]
    df = docs([t for _, t in rows], [i for i, _ in rows])
    got = spelling.group_variants(spelling.word_counts(spelling.misspelled(spelling.letter_runs(df))))
    assert found(got) == brute(query_counts(rows))


def test_query_on_a_whole_table(spark):
    from recordset.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = query_counts(rows)
    got = found(QUERIES["op12_spelling_variants"](spark, sf))
    assert [r[:2] for r in got] == sorted(counts.items())
    near = Counter()
    holes = {}
    for w in counts:
        for i in range(len(w)):
            for key in ((w[:i], w[i + 1:]), (w[:i] + w[i + 1:],)):
                holes.setdefault(key, set()).add(w)
        holes.setdefault((w,), set()).add(w)
    for w in counts:
        others = set().union(*(holes[k] for i in range(len(w)) for k in ((w[:i], w[i + 1:]), (w[:i] + w[i + 1:],))), holes[(w,)])
        near[w] = sum(one_edit(w, o) for o in others)
    assert {r[0]: r[2] for r in got} == {w: near[w] for w in counts}


def test_empty_tables(spark, docs):  # noqa: F811
    ensure_checkpoint_dir(spark)
    assert spelling.spelling_variants(docs([])).collect() == []
    assert spelling.spelling_variants(docs([None, "", "ab cd"])).collect() == []
    twice = spelling.spelling_variants(docs(["wordword Wordword"]))
    assert found(twice) == [("wordword", 2, 0, None, None, "wordword")]
    assert [f.dataType for f in twice.schema if f.name == "n_near"] == [T.LongType()]
