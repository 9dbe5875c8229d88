"""The stored layout: a write rewrites only its buckets, loses nothing, and publishes atomically."""

import os
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordset.operators import keyed_write as W
from recordset.operators import lookup as L
from recordset.operators.bucketed_write import bucket_cut, write_bucketed
from recordset.sources import layout
from recordset.sources import store as S
from recordset.sources.store import scan_set

AS_OF = 100


def spec(name, mode="append", **kw):
    return W.WriteSpec(name, mode=mode, key_col="k", as_of=AS_OF, **kw)


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def files(root, manifest):
    return {b: sorted(f for f in os.listdir(f"{root}/data/w={w}/__bucket={b}") if f.endswith(".parquet")) for b, w in manifest.folders.items()}


def test_only_touched_buckets_change(spark, tmp_out):
    root = f"{tmp_out}/big"
    write_bucketed(spark, numbers(spark, 200), root, spec("big"), buckets=8)
    _, before = layout.latest_version(spark, root)
    assert len(before.folders) == 8 and all(len(f) == 1 for f in files(root, before).values())  # one file a bucket
    upd = spark.createDataFrame([(7, -1)], "k bigint, v bigint")
    write_bucketed(spark, upd, root, spec("big"))
    n, after = layout.latest_version(spark, root)
    assert n == 2 and len([b for b in before.folders if before.folders[b] != after.folders[b]]) == 1
    v = scan_set(spark, root, as_of=AS_OF)
    assert v.count() == 200 and layout.BUCKET not in v.columns
    r = v.where("__key = '7'").first()
    assert r["v"] == -1 and r["__generation"] == 2
    # Same records as a whole-set merge.
    empty = spark.createDataFrame([], "__key string, __digest binary, __expiry int, __generation int, k bigint, v bigint")
    whole = W.merge(W.merge(empty, numbers(spark, 200), spec("big")), upd, spec("big"))
    assert sorted(tuple(x) for x in whole.select("__key", "v", "__generation").collect()) == \
        sorted(tuple(x) for x in v.select("__key", "v", "__generation").collect())


def test_bucket_count_belongs_to_the_set(spark, tmp_out):
    root = f"{tmp_out}/b"
    write_bucketed(spark, numbers(spark, 20), root, spec("b"), buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        write_bucketed(spark, numbers(spark, 20), root, spec("b"), buckets=5)
    write_bucketed(spark, numbers(spark, 28), root, spec("b"))
    assert scan_set(spark, root, as_of=AS_OF).count() == 28


def test_load_writes_few_files(spark, tmp_out):
    root = f"{tmp_out}/load"
    write_bucketed(spark, numbers(spark, 20_000).repartition(16), root, spec("load"), buckets=32)
    _, m = layout.latest_version(spark, root)
    assert sum(map(len, files(root, m).values())) == 32
    assert layout.choose_buckets(numbers(spark, 20_000)) == 1


def test_large_bucket_is_written_by_several_tasks(spark, tmp_out):
    root, size = f"{tmp_out}/one", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256KB")
    try:
        write_bucketed(spark, numbers(spark, 200_000), root, spec("one"), buckets=1)
        _, first = layout.latest_version(spark, root)
        write_bucketed(spark, numbers(spark, 200_000).withColumn("v", F.lit(1)), root, spec("one"))  # a fold into the base
        _, second = layout.latest_version(spark, root)
    finally:
        spark.conf.set(size, before)
    for m in (first, second):
        assert m.rows == 200_000 and list(m.folders) == [0]
        assert len(files(root, m)[0]) > 2  # no task had all of the bucket
        assert m.bytes == sum(os.path.getsize(f"{root}/data/w={m.folders[0]}/__bucket=0/{f}") for f in files(root, m)[0])
    assert scan_set(spark, root, as_of=AS_OF).where("v = 1 AND __generation = 2").select("k").distinct().count() == 200_000


def test_lookup_groups_are_dealt_to_all_tasks(spark):
    """Groups of a key each are not gathered into one task by their few bytes."""
    from recordset.plans.q_roundtrip import lookup_mixed_key_types_q

    plan = lookup_mixed_key_types_q(spark, "/root/testdata/sf0.001")
    assert "hashpartitioning(k" in (text := plan._jdf.queryExecution().executedPlan().toString()) and "REPARTITION_BY_NUM" in text


def test_new_bin_stays(spark, tmp_out):
    root = f"{tmp_out}/extra"
    write_bucketed(spark, numbers(spark, 200), root, spec("extra"), buckets=8)
    for k in range(0, 200, 25):
        write_bucketed(spark, spark.createDataFrame([(k, f"e{k}")], "k bigint, extra string"), root, spec("extra"))
    write_bucketed(spark, numbers(spark, 200), root, spec("extra"))
    v = scan_set(spark, root, as_of=AS_OF)
    assert {r["k"]: r["extra"] for r in v.where("extra is not null").collect()} == {k: f"e{k}" for k in range(0, 200, 25)}
    with pytest.raises(ValueError, match="stored as"):
        write_bucketed(spark, spark.createDataFrame([(1, 2.5)], "k bigint, extra double"), root, spec("extra"))


def test_empty_writes(spark, tmp_out):
    root = f"{tmp_out}/none"
    write_bucketed(spark, numbers(spark, 0), root, spec("none"), buckets=4)
    assert scan_set(spark, root, as_of=AS_OF).count() == 0
    write_bucketed(spark, numbers(spark, 3), root, spec("none"))
    write_bucketed(spark, numbers(spark, 0), root, spec("none"))
    assert scan_set(spark, root, as_of=AS_OF).count() == 3 and layout.latest_version(spark, root)[0] == 3


def test_plain_set_is_taken_over(spark, tmp_out):
    root = f"{tmp_out}/people"
    S.as_set(numbers(spark, 20), "people", "k").write.parquet(root)
    write_bucketed(spark, spark.createDataFrame([(99, 1)], "k bigint, v bigint"), root, spec("people"), buckets=4)
    assert scan_set(spark, root, as_of=AS_OF).count() == 21
    bare = f"{tmp_out}/bare"
    numbers(spark, 3).write.parquet(bare)
    with pytest.raises(ValueError, match="no stored set"):
        write_bucketed(spark, numbers(spark, 3), bare, spec("bare"))


def test_key_types_are_different_records(spark, tmp_out):
    root = f"{tmp_out}/typed"
    write_bucketed(spark, spark.createDataFrame([(1, "int")], "k bigint, s string"), root, spec("typed"), buckets=4)
    text = spark.createDataFrame([("1", "text")], "kk string, s string")
    write_bucketed(spark, text, root, W.WriteSpec("typed", mode="append", key_col="kk", as_of=AS_OF))
    got = scan_set(spark, root, as_of=AS_OF).select("__key", "s").collect()
    assert sorted(map(tuple, got)) == [("1", "int"), ("1", "text")]


def test_null_key_fails(spark, tmp_out):
    bad = spark.createDataFrame([(None, 1), (2, 2)], "k bigint, v bigint")
    with pytest.raises(PySparkException, match="needs a key"):
        write_bucketed(spark, bad, f"{tmp_out}/null", spec("null"), buckets=2)
    assert layout.latest_version(spark, f"{tmp_out}/null") == (0, None)


def test_lookup_reads_only_key_buckets(spark, tmp_out):
    root = f"{tmp_out}/people"
    base = spark.range(300).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    write_bucketed(spark, base, root, spec("people"), buckets=16)
    ds = spark.createDataFrame([(5,), (77,), (5000,)], "k bigint")
    cut = bucket_cut(spark, root, ds, "k", "people", as_of=AS_OF)
    want = [("5", "n5"), ("77", "n77")]
    assert sorted((r.key, r.name) for r in L.lookup_wide(ds, "k", cut, ["name"]).collect()) == want
    assert cut.select(F.input_file_name()).distinct().count() <= 3  # of 16 buckets
    text = ds.select(F.col("k").cast("string").alias("k"))  # a text key is another record than the integer key that reads the same
    cut = bucket_cut(spark, root, text, "k", "people", as_of=AS_OF)
    assert L.lookup_wide(text, "k", cut, ["name"]).collect() == []


def test_concurrent_writers_lose_nothing(spark, tmp_out):
    root = f"{tmp_out}/race"
    write_bucketed(spark, numbers(spark, 1), root, spec("race"), buckets=2)
    errors = []

    def write(i):
        try:
            write_bucketed(spark, spark.createDataFrame([(i, i)], "k bigint, v bigint"), root, spec("race"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(10, 14)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sorted(r["k"] for r in scan_set(spark, root, as_of=AS_OF).collect()) == [0, 10, 11, 12, 13]
    assert layout.latest_version(spark, root)[0] == 5


def test_publishing_a_taken_version_is_refused(spark, tmp_out):
    m = layout.Manifest(1, 2, "{}")
    layout.publish(spark, f"{tmp_out}/p", m)
    with pytest.raises(layout.PublishConflict):
        layout.publish(spark, f"{tmp_out}/p", m)
    assert os.listdir(f"{tmp_out}/p/_manifests") in (["m-0000000001.json"], ["m-0000000001.json", ".m-0000000001.json.crc"])


def test_create_only_write_fails_whole(spark, tmp_out):
    root = f"{tmp_out}/once"
    write_bucketed(spark, numbers(spark, 3), root, spec("once"), buckets=2)
    with pytest.raises(W.WriteConflict):
        write_bucketed(spark, numbers(spark, 5), root, spec("once", "errorifexists"))
    assert scan_set(spark, root, as_of=AS_OF).count() == 3


def test_renamed_metadata_is_not_stored_as_bins(spark, tmp_out):
    kw = {"namespace": tmp_out, "as_of": AS_OF}
    W.write_set(spark, numbers(spark, 3), "ren", "k", mode="append", **kw)
    names = {"keyColumn": "id", "expiryColumn": "expires", "ttlColumn": "left", "generationColumn": "gen", "digestColumn": "dig"}
    seen = scan_set(spark, "ren", **kw, **names)
    W.write_set(spark, seen, "ren", "k", mode="append", **kw, **names)
    assert scan_set(spark, "ren", **kw).columns == ["__key", "__digest", "__expiry", "__generation", "__ttl", "k", "v"]
