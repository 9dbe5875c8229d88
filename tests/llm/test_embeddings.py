"""Embedding near-dedup and whitening against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm import embedding_dedup, whitening
from recordset.session import ensure_checkpoint_dir


def frame(spark, rows, element=None):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(element or T.FloatType())), T.StructField("label", T.IntegerType()),
                           T.StructField("vec", T.StringType()), T.StructField("grp", T.StringType()), T.StructField("a.b", T.StringType())])
    return spark.createDataFrame([(i, v, k, "x", "y", "z") for i, v, k in rows], schema)


def clusters(seed, dim=24, labels=3, single=60, groups=((40, 0.12), (25, 0.3), (6, 0.35), (2, 0.2), (2, 0.25))):
    """Single vectors, tight and loose groups, and exact copies."""
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(labels):
        rows += [(rng.standard_normal(dim), label) for _ in range(single)]
        for size, spread in groups:
            base = rng.standard_normal(dim)
            base /= np.linalg.norm(base)
            for _ in range(size):
                noise = rng.standard_normal(dim)
                rows.append((base * 3 + 3 * spread * noise / np.linalg.norm(noise), label))
    rows += [rows[i] for i in rng.integers(0, len(rows), 30)]
    order = rng.permutation(len(rows))
    return [(i, [float(np.float32(x)) for x in rows[j][0]], rows[j][1]) for i, j in enumerate(order)]


def brute(rows, cosine=0.93):
    use = [(i, np.array(v, float), k) for i, v, k in rows if i is not None and k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, comp = {}, {i: i for i, _, _ in use}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    degree = np.zeros(len(use), int)
    for x, (i, u, k) in enumerate(use):
        for y in range(x):
            j, v, m = use[y]
            if k == m and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= cosine:
                degree[[x, y]] += 1
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    for (i, _, _), d in zip(use, degree):
        links.setdefault(i, []).append(int(d))
    out = []
    for i, v, k in rows:
        good = any(i == j for j, _, _ in use) and k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        n = links[i].pop(0) if good else 0
        c = find(i) if good else i
        out.append((i, n, c, c == i))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 8), (3, 3)])
def test_links_and_components_match_brute_force(spark, seed, block):
    ensure_checkpoint_dir(spark)
    rows = clusters(seed)
    want = brute(rows)
    assert max(n for _, n, _, _ in want) > 30
    assert found(embedding_dedup.link_vectors(frame(spark, rows), block=block)) == want


def test_small_windows_miss_few_pairs(spark):
    """Windows far smaller than the labels: the passes still find what they should."""
    ensure_checkpoint_dir(spark)
    rng = np.random.default_rng(7)
    rows, pairs = [], 400
    for p in range(pairs):
        base = rng.standard_normal(32)
        base /= np.linalg.norm(base)
        side = rng.standard_normal(32)
        side -= side @ base * base
        side /= np.linalg.norm(side)
        angle = np.arccos(rng.uniform(0.932, 0.99))
        rows += [(2 * p, base.tolist(), 0), (2 * p + 1, (np.cos(angle) * base + np.sin(angle) * side).tolist(), 0)]
    out = embedding_dedup.link_vectors(frame(spark, rows, T.DoubleType()), window=4)
    assert out.filter("n_links = 1").count() >= 0.99 * 2 * pairs
    assert embedding_dedup.passes_for(10**9) > embedding_dedup.passes_for(10**6) > embedding_dedup.passes_for(10**3) == embedding_dedup.passes_for(1000)


def test_odd_vectors(spark):
    ensure_checkpoint_dir(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [1.0, nan], 0), (6, [1.0, -inf], 0), (7, [1.0, 1.0], None), (8, [1.0, 1.0], 0),
            (9, [2.0, 2.0], 0), (10, [1.0, 1.0], 1), (None, [1.0, 1.0], 0), (11, [1.0, 1.0, 0.0], 0), (12, [1.0, 1.0], 0), (12, [1.0, 1.0], 0), (13, [-1.0, -1.0], 0), (14, [1e-30, 1e-30], 0)]
    assert found(embedding_dedup.link_vectors(frame(spark, rows))) == brute(rows)
    large = [(1, [1e200, 1e200], 0), (2, [1e-200, 1e-200], 0), (3, [1e300, -1e300], 0)]
    assert found(embedding_dedup.link_vectors(frame(spark, large, T.DoubleType()))) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert embedding_dedup.link_vectors(frame(spark, [])).collect() == []


def test_one_id_of_several_vectors_and_text_ids(spark):
    ensure_checkpoint_dir(spark)
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 0.01], 0), (4, [-1.0, 0.0], 0)]
    got = found(embedding_dedup.link_vectors(frame(spark, rows)))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]
    text = frame(spark, rows[2:]).withColumn("vec_id", F.concat(F.lit("v"), "vec_id"))
    assert found(embedding_dedup.link_vectors(text)) == [("v2", 0, "v2", True), ("v3", 0, "v3", True), ("v4", 0, "v4", True)]


def test_no_row_for_each_pair_of_a_dense_group(spark):
    """A group of m vectors hands on at most m rows for a task and pass."""
    ensure_checkpoint_dir(spark)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.05 * rng.standard_normal(16)).tolist(), 0) for i in range(600)]
    packed, dtype = embedding_dedup._packed(frame(spark, rows), "embedding", "vec_id", "label")
    classes = packed.groupBy("grp", "h1", "h2", "vec").agg(F.min("id").alias("cls"))
    ordered = embedding_dedup._keyed(classes, 5, dtype).repartitionByRange(2, "pass", "size", "grp", "key", "cls").sortWithinPartitions("pass", "size", "grp", "key", "cls")
    stars = embedding_dedup._window_links(ordered, 0.93, 48, dtype)
    assert 0 < stars.count() <= 5 * 600 + 2 * 48
    assert found(embedding_dedup.link_vectors(frame(spark, rows))) == [(i, 599, 0, i == 0) for i in sorted(range(600), key=lambda i: str((i, 599, 0, i == 0)))]


# Whitening

def spectrum(rng, values):
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(5, 1, 20), np.geomspace(1, 1e-9, 20), np.r_[[3.0] * 5, [2 + 1e-9, 2.0, 2 - 1e-9], np.linspace(1, 0.5, 12)], np.r_[[1.0] * 20], np.r_[[4.0, 1.0], np.zeros(18)],
    np.r_[1 + 1e-7 * np.arange(10), 1e-3 * (1 + 1e-6 * np.arange(10))]])
def test_eigenvectors_are_refined_to_double_precision(values):
    rng = np.random.default_rng(5)
    a = spectrum(rng, values)
    a = (a + a.T) / 2
    e, x = whitening.refined_eigen(a)
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-14 * len(values) * values.max()
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ x - x * e).max() < 1e-13 * np.abs(values).max()
    _, exact = np.linalg.eigh(a)
    gap = np.abs(np.subtract.outer(e, e) + np.eye(len(e)) * 9).min(axis=1)
    for j in np.flatnonzero(gap > 1e-3 * values.max()):
        assert 1 - abs(x[:, j] @ exact[:, ::-1][:, j]) < 1e-12


def test_single_precision_start_alone_would_not_do():
    a = spectrum(np.random.default_rng(8), np.linspace(2, 1, 40))
    _, single = np.linalg.eigh(a.astype(np.float32))
    assert np.abs(single.astype(float).T @ single.astype(float) - np.eye(40)).max() > 1e-9


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((700, 12)) @ rng.standard_normal((12, 12)) + 5
    df = frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)], T.DoubleType()).repartition(7)
    model = whitening.fit_whitening(df, "embedding")
    v = np.cov(x.T, bias=True)
    e, q = np.linalg.eigh(v)
    assert model.n == 700 and np.allclose(model.covariance, v, rtol=1e-12) and np.allclose(model.values, e[::-1], rtol=1e-11)
    out = whitening.whiten(df, model, "embedding", k=5)
    assert whitening.identity_error(out) < 1e-12 and out.columns == [*df.columns, "whitened"]
    want = (x - x.mean(0)) @ q[:, ::-1][:, :5] / np.sqrt(e[::-1][:5])
    got = np.array([r.whitened for r in out.orderBy("vec_id").collect()])
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-9) and np.allclose(np.abs((got * want).sum(0)), (want * want).sum(0))


def test_whitening_of_whole_numbers_far_from_zero(spark):
    """A common offset costs no digits, however large."""
    rng = np.random.default_rng(4)
    x = rng.integers(-30, 30, (300, 6))
    make = lambda m: spark.createDataFrame([(i, (v + m).tolist()) for i, v in enumerate(x)], "vec_id long, x array<long>").repartition(5)
    near, far = (whitening.fit_whitening(make(m), "x") for m in (0, 10**12))
    assert far.sums.tolist() == (x.sum(0) + 300 * 10**12).tolist()
    assert np.allclose(near.covariance, far.covariance, rtol=1e-13) and np.allclose(near.covariance, np.cov(x.T, bias=True), rtol=1e-13)
    a, b = (np.array([r.whitened for r in whitening.whiten(make(m), w, "x").orderBy("vec_id").collect()]) for m, w in ((0, near), (10**12, far)))
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-10)


def test_odd_tables_for_whitening(spark):
    nan = float("nan")
    rows = [(1, None, 0), (2, [], 0), (3, [1.0, None], 0), (4, [1.0, nan], 0), (5, [1.0, 2.0], 0), (6, [3.0, 5.0], 0), (6, [3.0, 5.0], 0), (7, [1.0, 2.0, 3.0], 0), (8, [0.0, 1.0], None)]
    df = frame(spark, rows)
    model = whitening.fit_whitening(df, "embedding")
    assert (model.n, model.dimension) == (4, 2)
    out = {r.vec_id: r.whitened for r in whitening.whiten(df, model, "embedding").collect()}
    assert [out[i] for i in (1, 2, 3, 4, 7)] == [None] * 5 and len(out[5]) == 2
    empty = frame(spark, [])
    assert whitening.fit_whitening(empty, "embedding") is None and whitening.whiten(empty, None, "embedding").collect() == []
    assert whitening.identity_error(whitening.whiten(empty, None, "embedding")) == 0.0
    same = frame(spark, [(i, [1.0, 2.0], 0) for i in range(5)])
    assert [r.whitened for r in whitening.whiten(same, whitening.fit_whitening(same, "embedding"), "embedding").collect()] == [[]] * 5


def test_whitening_query_contract(spark):
    from recordset.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(64 * np.array([r.embedding for r in table], float)).astype(np.int64) + 1_000_000
    rows = QUERIES["op13_embedding_whitening"](spark, sf).orderBy("vec_id", "component").collect()
    assert len(rows) == 32 * len(x) and {r.n for r in rows} == {len(x)} and rows[0].identity_error < 1e-12
    s, n = x.sum(0), len(x)
    dev = ((n * x - s) ** 2).sum(1)
    assert [r.deviation for r in rows[::32]] == dev.tolist()
    y = x - s / n
    e, q = np.linalg.eigh(y.T @ y / n)
    want = y @ q[:, ::-1][:, :32] / np.sqrt(e[::-1][:32])
    got = np.array([r.whitened for r in rows]).reshape(n, 32)
    assert np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-7)
    assert np.allclose([r.explained for r in rows[:32]], (e[::-1] / e.sum())[:32], rtol=1e-10)
