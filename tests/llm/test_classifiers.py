"""Quality classifier, quality rules and toxicity: statistics against brute force, held-out accuracy, odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordset.llm import quality, rules, toxicity
from llm_helpers import ODD_TEXTS, prose, space_words, docs  # noqa: F401


def labelled(n, seed=5):
    rng = random.Random(seed)
    texts, good, toxic = [], [], []
    for i in range(n):
        words = prose(rng, rng.randrange(55, 90), 400).split()
        good.append(int(rng.random() < 0.7))
        toxic.append(int(rng.random() < 0.3))
        if toxic[-1]:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vilebad", "vileworse", "vileness"]))
        if not good[-1]:
            words = [w + "%%" for w in words]
        texts.append(" ".join(words))
    return texts, good, toxic


@pytest.fixture(scope="module")
def sample(spark):
    texts, good, toxic = labelled(400)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(zip(good, toxic))], "doc_id bigint, quality int, toxic int")
    return docs, labels, good, toxic


def brute_stats(text):
    text = text or ""
    words = space_words(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if space_words(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


def test_rule_statistics_match_brute_force():
    rng = random.Random(3)
    texts = ODD_TEXTS + ["".join(rng.choice("ab \n\té#") for _ in range(rng.randrange(200))) for _ in range(300)]
    got = np.array(rules.text_stats(pa.array(texts, pa.string()))).T.tolist()
    assert got == [brute_stats(t) for t in texts]


def test_quality_separates_held_out_rows(sample):
    docs, labels, good, _ = sample
    model = quality.fit_quality(docs, labels, keep=F.col("doc_id") % 4 != 2)
    rows = quality.score_quality(docs, model).collect()
    held = [r for r in rows if r.doc_id % 4 == 2]
    assert len(rows) == 400 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == good[r.doc_id] for r in held]) > 0.97


def test_toxicity_separates_held_out_rows(sample):
    docs, labels, _, toxic = sample
    model = toxicity.fit_toxicity(docs, labels, keep=F.col("doc_id") % 5 != 0)
    rows = toxicity.score_toxicity(docs, model).collect()
    held = [r for r in rows if r.doc_id % 5 == 0]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97


def test_toxicity_models_are_distributions():
    """Over all next bytes each class's probabilities add up to one, in a context that was met and in one that was not."""
    texts, _, toxic = labelled(120)
    m = toxicity.fit_models([np.frombuffer(t.encode(), np.uint8) for t in texts], np.array(toxic))
    for context in (b" vile", b" w12 w", b"zzzzz"):
        every = np.concatenate([np.frombuffer(context + bytes([b]), np.uint8) for b in range(256)])
        f = toxicity.Folded(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        f.buf, f.place = every, np.tile(np.arange(len(context) + 1), 256)
        p = np.repeat(m["shared"][f.buf][:, None], 2, axis=1)
        strings = f.strings()
        for n, parts, lam in reversed(list(zip(toxicity.ORDERS, m["parts"], m["lam"]))):
            p = toxicity.read_slots(parts, strings[n]) + toxicity.read_slots(lam, toxicity._context(strings[n], n)) * p
        assert np.allclose(p[len(context)::len(context) + 1].sum(axis=0), 1, atol=1e-3)


@pytest.mark.parametrize("n", [0, 1, 300, 5000, 700_000])
def test_every_key_reads_back_its_value(n):
    """Whatever the number of keys, none is lost and none reads as another."""
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 62, 2 * n, dtype=np.uint64))
    rng.shuffle(keys)
    keys, absent = keys[:n], keys[n:]
    values = rng.random((n, 2)) + 1
    slots = toxicity.build_slots(keys, values, 0.0)
    assert (toxicity.read_slots(slots, keys) == values.astype(np.float32)).all()
    assert len(slots[0]) <= max(256, 4 * n) and (toxicity.read_slots(slots, absent) > 0).any(axis=1).mean() < 1e-6 if n else True


def test_every_counted_string_keeps_its_share():
    """Each string above the discount has its own share in the model, in either class."""
    rng = random.Random(3)
    texts = [np.frombuffer(prose(rng, 400, 5000).encode(), np.uint8) for _ in range(120)]
    y = np.arange(120) % 2
    m = toxicity.fit_models(texts, y)
    for k in (0, 1):
        keys, counts = toxicity._count([t for t, label in zip(texts, y) if label == k])
        n = toxicity.ORDERS[0]
        ctx = toxicity._context(keys, n)
        total = {}
        for c, x in zip(counts.tolist(), ctx.tolist()):
            total[x] = total.get(x, 0) + c
        want = np.array([max(c - toxicity.DISCOUNT, 0) / total[x] for c, x in zip(counts.tolist(), ctx.tolist())])
        assert (want > 0).sum() > 1000 and np.allclose(toxicity.read_slots(m["parts"][0], keys)[:, k], want, rtol=1e-6)


def test_rules_keep_clean_rows(sample):
    docs, labels, good, _ = sample
    rows = rules.apply_rules(docs, rules.fit_rule_model(docs, labels)).collect()
    assert np.mean([r.kept == bool(good[r.doc_id]) for r in rows]) > 0.97


@pytest.mark.parametrize("fit,score", [(quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity),
                                       (rules.fit_rule_model, rules.apply_rules)])
def test_odd_rows(spark, sample, docs, fit, score):
    _, labels, *_ = sample
    odd = docs(ODD_TEXTS + ODD_TEXTS, ids=[0] * 4 + [None] + list(range(5, 2 * len(ODD_TEXTS))))
    noisy = spark.createDataFrame([(0, 1, 1), (0, 0, 0), (None, 1, 1), (6, None, None), (7, 3, 3), (8, 1, 0), (9, 0, 1), (8, 1, 0)], "doc_id bigint, quality int, toxic int")
    for lab in (labels, noisy, noisy.limit(0), noisy.filter("doc_id = 8")):
        rows = score(odd, fit(odd, lab)).collect()
        assert len(rows) == odd.count()
        again = Counter((r["text"], str([r[c] for c in r.__fields__ if c not in ("doc_id", "text")])) for r in rows)
        assert all(n >= 2 for n in again.values())  # equal texts are judged alike
        assert "old" not in {r[c] for r in rows for c in r.__fields__ if c.lower() == ("kept" if fit is rules.fit_rule_model else "score")}
    assert score(odd.limit(0), fit(odd.limit(0), labels)).collect() == []


def test_training_sample_is_bounded(spark, sample):
    docs, labels, *_ = sample
    from recordset.llm.frames import labelled_sample

    assert labelled_sample(docs, labels, "quality", 60).count() < 110
    rows = labelled_sample(docs, labels, "quality", 60).collect()
    assert abs(sum(r.weight for r in rows) - 400) < 200
