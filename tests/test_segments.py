"""Deltas, growth, expiry and conflicts of the stored layout, and writes whose input cannot be read twice."""

import random
import threading

from pyspark.sql import functions as F

from recordset.operators import bucketed_write as B
from recordset.operators import keyed_write as W
from recordset.operators import lookup as L
from recordset.sources import layout
from recordset.sources.store import scan_set

AS_OF = 100


def spec(name, mode="append", **kw):
    return W.WriteSpec(name, mode=mode, key_col="k", as_of=AS_OF, **kw)


def numbers(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def now(spark, root):
    return layout.latest_version(spark, root)[1]


def test_rows_that_differ_at_every_reading_destroy_nothing(spark, tmp_out):
    """Each reading of the incoming row gives another key: the stored records all stay and each write adds one."""
    root = f"{tmp_out}/once"
    B.write_bucketed(spark, numbers(spark, 40), root, spec("once"), buckets=16)
    for _ in range(6):
        fresh = spark.range(1).select((F.rand() * 1e15 + 1e6).cast("bigint").alias("k"), F.lit(1).cast("bigint").alias("v"))
        B.write_bucketed(spark, fresh, root, spec("once"))
    got = [r["k"] for r in scan_set(spark, root, as_of=AS_OF).collect()]
    assert len(got) == 46 and set(range(40)) <= set(got) and layout._names(spark, f"{root}/_staging/*") == []


def test_linear_hashing_addresses(spark):
    """The Column and the plain rule agree; a growing count moves records out of the parents only."""
    h = [r[0] for r in spark.range(300).select(F.xxhash64(F.unhex(F.sha1(F.col("id").cast("string"))))).collect()]
    for n in (1, 2, 3, 5, 8, 13, 16):
        col = layout.bucket_of(F.unhex(F.sha1(F.col("id").cast("string"))), n)
        assert [r[0] for r in spark.range(300).select(col).collect()] == [layout.address(x, n) for x in h]
    for n in range(1, 40):
        for m in range(n, 60):
            moved = {layout.address(x, n) for x in range(4096) if layout.address(x, n) != layout.address(x, m)}
            assert moved <= set(layout.split_parents(n, m)) and all(0 <= layout.address(x, m) < m for x in range(256))


def test_set_grows_by_appends(spark, tmp_out):
    root, size = f"{tmp_out}/grow", 4 << 10
    rows = spark.range(8000).select(F.col("id").alias("k"), F.sha1(F.col("id").cast("string")).alias("v"))
    B.write_bucketed(spark, rows.where("k < 8"), root, spec("grow"), buckets=1, bucket_bytes=size)
    assert now(spark, root).buckets == 1
    counts = []
    for lo, hi in ((8, 80), (80, 800), (800, 4000), (4000, 8000)):
        B.write_bucketed(spark, rows.where(f"k >= {lo} AND k < {hi}"), root, spec("grow"), bucket_bytes=size)
        m = now(spark, root)
        counts.append(m.buckets)
        assert max(sum(s.bytes for s in own) for own in m.segments.values()) < 2 * size
    assert counts == sorted(counts) and counts[-1] > 64
    got = scan_set(spark, root, as_of=AS_OF)
    assert sorted(tuple(r) for r in got.select("k", "v", "__generation").collect()) == sorted((r.k, r.v, 1) for r in rows.collect())
    placed = layout.read_buckets(spark, root, now(spark, root))
    assert placed.where(F.col(layout.BUCKET) != layout.bucket_of(F.col("__digest"), now(spark, root).buckets)).count() == 0


def test_small_upsert_stores_little(spark, tmp_out):
    root = f"{tmp_out}/delta"
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.sha1(F.col("id").cast("string")).alias("v"))
    B.write_bucketed(spark, rows, root, spec("delta"), buckets=4)
    before = now(spark, root)
    few = spark.range(0, 20_000, 200).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    B.write_bucketed(spark, few, root, spec("delta"))
    after = now(spark, root)
    assert all(after.segments[b][0] == before.segments[b][0] for b in before.segments)
    assert sum(own[-1].rows for own in after.segments.values()) == 100 and after.bytes - before.bytes < before.bytes / 10
    got = scan_set(spark, root, as_of=AS_OF)
    assert got.count() == 20_000 and got.where("v = 'new'").count() == 100 and got.where("v = 'new' AND __generation = 2").count() == 100
    assert got.where(F.col("v") == F.sha1(F.lit("200"))).count() == 0  # what a delta replaced is no longer found


def test_folding_by_size_tiers():
    seg = lambda n: layout.Segment("w", n)
    base = seg(10_000)
    assert B.folded_from((), 5) == 0 and B.folded_from((seg(10),), 5) == 0
    assert B.folded_from((base,), 5) == 1 and B.folded_from((base, seg(5), seg(5)), 5) == 3
    assert B.folded_from((base, seg(5), seg(5), seg(5)), 5) == 1
    assert B.folded_from((base, seg(900), seg(5), seg(5), seg(5)), 5) == 2
    assert B.folded_from((base, seg(20), seg(20), seg(20), seg(5), seg(5), seg(5)), 5) == 1
    assert B.folded_from((base, seg(3000), seg(1000)), 1500) == 0
    own, stored = (base,), 0
    for _ in range(2000):
        at = B.folded_from(own, 2)
        own = own[:at] + (seg(2 + sum(s.rows for s in own[at:])),)
        stored += own[-1].rows
    assert len(own) < 16 and stored < 2000 * 2 * 12


def test_random_writes_match_the_whole_merge(spark, tmp_out):
    """Deltas, folds, removed and new bins, generations and expiry: after each write the set is what merging the whole set gives."""
    root, rng = f"{tmp_out}/model", random.Random(11)
    empty = spark.createDataFrame([], "__key string, __digest binary, __expiry int, __generation int, k bigint, a string, b bigint")
    whole = empty
    fields = ["__key", "__generation", "__expiry", "a", "b"]
    for turn in range(7):
        n = rng.choice([3, 5, 60])
        keys = rng.sample(range(120), n)
        rows = [(k, rng.choice([None, f"a{turn}"]), turn * 1000 + k, rng.choice([None, -1, 5, 500])) for k in keys]
        df = spark.createDataFrame(rows, "k bigint, a string, b bigint, ttl bigint")
        if rng.random() < 0.4:
            df = df.drop("a")
        mode = rng.choice(["append", "append", "overwrite", "ignore", "update_only"]) if turn else "append"
        s = W.WriteSpec("model", mode=mode, key_col="k", as_of=AS_OF + 3 * turn, ttl_col="ttl")
        B.write_bucketed(spark, df, root, s, buckets=2)
        whole = W.merge(whole, df, s).select(*empty.columns).checkpoint() if spark.sparkContext.getCheckpointDir() else W.merge(whole, df, s).select(*empty.columns)
        live = f"__expiry = 0 OR __expiry > {s.as_of}"
        got = scan_set(spark, root, as_of=s.as_of)
        if "a" not in got.columns:
            got = got.withColumn("a", F.lit(None).cast("string"))
        assert sorted(map(tuple, got.select(*fields).collect()), key=str) == sorted(map(tuple, whole.where(live).select(*fields).collect()), key=str), turn
    assert any(len(own) > 1 for own in now(spark, root).segments.values())
    B.compact(spark, root, as_of=AS_OF + 18)
    m = now(spark, root)
    assert all(len(own) == 1 for own in m.segments.values()) and m.rows == scan_set(spark, root, as_of=AS_OF + 18).count()


def test_dead_buckets_go_unread(spark, tmp_out):
    root = f"{tmp_out}/dead"
    rows = numbers(spark, 200).withColumn("ttl", F.when(layout.bucket_of(W.digest("dead", "k", W.stored_form(numbers(spark, 1), spec("dead")).schema["k"].dataType), 8) < 3, 10).otherwise(-1))
    B.write_bucketed(spark, rows, root, spec("dead", ttl_col="ttl"), buckets=8)
    assert B.compact(spark, root, as_of=AS_OF + 5) is None
    after = B.compact(spark, root, as_of=AS_OF + 10)
    assert sorted(after.segments) == [3, 4, 5, 6, 7] and layout._names(spark, f"{root}/data/w=*") == [f"w={after.segments[3][0].write}"]
    assert scan_set(spark, root, as_of=AS_OF + 10, live_only=False).count() == after.rows < 200


def test_writers_of_other_buckets_do_not_merge_again(spark, tmp_out, monkeypatch):
    root = f"{tmp_out}/race"
    B.write_bucketed(spark, numbers(spark, 64), root, spec("race"), buckets=16)
    at = {}
    for k in range(64):
        at.setdefault(next(r[0] for r in spark.range(1).select(layout.bucket_of(W.tagged_digest("race", "L", F.lit(str(k))), 16)).collect()), k) if len(at) < 5 else None
    merges, errors, real = [], [], B._next_write
    monkeypatch.setattr(B, "_next_write", lambda *a: merges.append(1) or real(*a))

    def write(k):
        try:
            B.write_bucketed(spark, spark.createDataFrame([(k, -k)], "k bigint, v bigint"), root, spec("race"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in at.values()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and len(merges) == len(at) and now(spark, root).version == 1 + len(at)
    got = {r["k"]: r["v"] for r in scan_set(spark, root, as_of=AS_OF).collect()}
    assert got == {k: -k if k in at.values() else 10 * k for k in range(64)}


def test_writing_back_by_the_scanned_key(spark, tmp_out):
    """Integer, text and binary keys scanned and written back by ``__key`` stay the same records."""
    root = f"{tmp_out}/back"
    for col, values, t in (("i", [1, 2], "bigint"), ("s", ["1", "x"], "string"), ("y", [bytearray(b"1"), bytearray(b"\xff")], "binary")):
        df = spark.createDataFrame([(v, 1) for v in values], f"{col} {t}, n bigint")
        B.write_bucketed(spark, df, root, W.WriteSpec("back", mode="append", key_col=col, as_of=AS_OF), buckets=2)
    seen = scan_set(spark, root, as_of=AS_OF)
    before = {bytes(r["__digest"]): r["__key"] for r in seen.collect()}
    integers = seen.where("i IS NOT NULL OR s IS NOT NULL").withColumn("n", F.col("n") + 1)
    B.write_bucketed(spark, integers, root, W.WriteSpec("back", mode="append", key_col="__key", as_of=AS_OF))
    got = scan_set(spark, root, as_of=AS_OF)
    assert {bytes(r["__digest"]): r["__key"] for r in got.collect()} == before and got.columns == seen.columns
    assert sorted((r["n"], r["__generation"]) for r in got.collect()) == [(1, 1)] * 2 + [(2, 2)] * 4


def test_lookups_address_records_by_type(spark, tmp_out):
    root = f"{tmp_out}/typed"
    for col, t, v in (("i", "bigint", 1), ("s", "string", "1")):
        B.write_bucketed(spark, spark.createDataFrame([(v, t)], f"{col} {t}, kind string"), root, W.WriteSpec("typed", mode="append", key_col=col, as_of=AS_OF), buckets=2)
    view = scan_set(spark, root, as_of=AS_OF)
    for t, v in (("bigint", 1), ("string", "1")):
        ds = spark.createDataFrame([(v, t), (v, t)], f"k {t}, kind string")
        assert [r.kind for r in L.lookup_wide(ds, "k", view, ["kind"]).collect()] == [t]
        assert L.intersect_match(ds, "k", view.drop("i", "s")).count() == 2
        cut = B.bucket_cut(spark, root, ds, "k", "typed", as_of=AS_OF)
        assert [r.kind for r in L.lookup_wide(ds, "k", cut, ["kind"]).collect()] == [t]
