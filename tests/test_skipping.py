"""File skipping: keyed filters, ranges and contained items open only the files that can hold a match, and never change a result."""

import random

import pytest
from pyspark.sql import functions as F

from recordset import index_bins, reader, where, writer
from recordset.operators import bucketed_write as B
from recordset.operators import keyed_write as W
from recordset.sources import layout, skipping
from recordset.sources.store import scan_set

AS_OF = 100


def spec(name, mode="append", **kw):
    return W.WriteSpec(name, mode=mode, key_col=kw.pop("key_col", "k"), as_of=AS_OF, **kw)


def opened(df):
    """(bucket, write) of the files that the plan lists."""
    parts = [f.split("/data/w=")[1].split("/") for f in df.inputFiles()]
    return {(int(p[1].split("=")[1]), p[0]) for p in parts}


def rows_of(df, *cols):
    return sorted((tuple("nan" if v != v else v for v in r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    """64 buckets; list, map, number and text bins; then an upsert of every tenth record that takes items away."""
    root = str(tmp_path_factory.mktemp("sets")) + "/wide"
    k = F.col("id")
    rows = spark.range(3000).select(
        k.alias("k"), F.array(k % 500, k + 10_000).alias("tags"), F.create_map(F.concat(F.lit("m"), (k % 700).cast("string")), k).alias("refs"),
        (k * 1.5).alias("price"), F.concat(F.lit("name-"), F.lpad(k.cast("string"), 6, "0")).alias("name"))
    B.write_bucketed(spark, rows, root, spec("wide"), buckets=64, index=("tags", "refs", "price", "name"))
    late = spark.range(0, 3000, 10).select(
        k.alias("k"), F.array(F.lit(77_777), F.lit(None).cast("bigint")).alias("tags"), F.create_map(F.lit("late"), k).alias("refs"),
        (k + 1_000_000.0).alias("price"), F.lit("z" * 200).alias("name"))
    B.write_bucketed(spark, late, root, spec("wide"))
    return root


@pytest.fixture(scope="module")
def whole(spark, indexed):
    df = scan_set(spark, indexed, as_of=AS_OF).select("__key", "k", "price", "name", "tags", "refs").cache()
    yield df
    df.unpersist()


FILTERS = [
    where("__key", "=", "17"), where("__key", "=", 17), where("__key", "in", ["20", 31, "none"]), where("tags", "=", 123), where("tags", "=", 77_777),
    where("tags", "in", [3, 10_005]), where("refs", "=", "m42"), where("refs", "=", "late"), where("refs", "=", "no such"), where("price", ">=", 1_000_000.0),
    where("price", "<", 3.0), where("price", "between", (10.0, 20.0)), where("price", "=", 15), where("name", "=", "name-000021"), where("name", "prefix", "z" * 100),
    where("name", "prefix", "name-00002"), where("name", ">", "z" * 199), where("name", ">", "z" * 200), where("name", "suffix", "77"), where("k", "=", 12), where("name", "present"),
    where("tags", "=", 123) & where("price", ">", 500.0), where("tags", "=", 123) | where("__key", "=", "9"), where("k", ">", 2990) & where("refs", "=", "m699"),
    where("k", ">", 2990) | where("refs", "=", "m699"), where("tags", "in", []), where("price", "=", "15.0"),
]


@pytest.mark.parametrize("n", range(len(FILTERS)))
def test_same_records_as_the_full_scan(spark, indexed, whole, n):
    f = FILTERS[n]
    assert rows_of(scan_set(spark, indexed, as_of=AS_OF, where=f), "__key", "price", "name") == rows_of(whole.where(f.column(whole)), "__key", "price", "name")


def test_key_filter_opens_one_bucket(spark, indexed):
    got = scan_set(spark, indexed, as_of=AS_OF, where=where("__key", "=", "17"))
    assert len({b for b, _ in opened(got)}) == 1 and got.count() == 1
    assert len({b for b, _ in opened(scan_set(spark, indexed, as_of=AS_OF, where=where("__key", "in", ["17", "18"])))}) <= 2


def test_contains_opens_the_buckets_that_hold_the_item(spark, indexed):
    manifest = layout.latest_version(spark, indexed)[1]
    stored = layout.read_buckets(spark, indexed, manifest, with_write=True)
    for f in (where("tags", "=", 123), where("refs", "=", "m42"), where("name", "=", "name-000021")):
        holding = {(r[0], r[1]) for r in stored.where(f.column(stored)).select(layout.BUCKET, layout.WRITE).collect()}
        files = opened(scan_set(spark, indexed, as_of=AS_OF, where=f))
        assert {b for b, _ in files} == {b for b, _ in holding} and len(files) < 20
    assert opened(scan_set(spark, indexed, as_of=AS_OF, where=where("refs", "=", "no such"))) == set()


def test_what_only_deltas_hold_leaves_the_bases_closed(spark, indexed):
    manifest = layout.latest_version(spark, indexed)[1]
    bases = {(b, own[0].write) for b, own in manifest.segments.items() if len(own) > 1}
    assert bases
    for f in (where("price", ">=", 1_000_000.0), where("tags", "=", 77_777), where("refs", "=", "late"), where("name", "prefix", "zz")):
        files = opened(scan_set(spark, indexed, as_of=AS_OF, where=f))
        assert files and not files & bases


def test_replaced_values_are_not_found_again(spark, indexed):
    """Record 20 had tag 20 and key m20 before the upsert: the base still holds them, its bucket is read, the record is not found."""
    got = scan_set(spark, indexed, as_of=AS_OF, where=where("tags", "=", 20))
    assert "20" not in {r[0] for r in got.select("__key").collect()} and scan_set(spark, indexed, as_of=AS_OF, where=where("tags", "=", 10_020)).count() == 0


def test_random_writes_and_filters(spark, tmp_out):
    """Deltas, folds, splits, expiry and removed bins: a filtered scan is the filter over the whole scan, at each version."""
    root, rng = f"{tmp_out}/rand", random.Random(5)
    for turn in range(4):
        picked = rng.sample(range(300), 250 if turn == 0 else rng.choice([4, 30, 120]))
        rows = [(k, [rng.randrange(40), None] if rng.random() < 0.8 else None, rng.choice([None, float(turn * 50 + k % 9), float("nan"), -0.0]), rng.choice([None, f"t{k % 13}"]), rng.choice([-1, 5])) for k in picked]
        df = spark.createDataFrame(rows, "k bigint, tags array<bigint>, v double, t string, ttl bigint")
        s = W.WriteSpec("rand", mode=rng.choice(["append", "overwrite"]), key_col="k", as_of=AS_OF + 2 * turn, ttl_col="ttl")
        B.write_bucketed(spark, df, root, s, buckets=4 if turn == 0 else None, bucket_bytes=6 << 10, **({"index": ("tags", "v", "t")} if turn == 0 else {}))
        whole = scan_set(spark, root, as_of=s.as_of)
        for f in (where("tags", "=", rng.randrange(40)), where("v", ">=", float(turn * 50)), where("v", "=", 0.0), where("t", "=", "t7") & where("tags", "in", [1, 2, 3]),
                  where("v", "=", float("nan")), where("__key", "=", rng.choice(picked)) | where("t", "prefix", "t1")):
            got = scan_set(spark, root, as_of=s.as_of, where=f)
            assert rows_of(got, "__key", "v", "t", "__generation") == rows_of(whole.where(f.column(whole)), "__key", "v", "t", "__generation"), (turn, f)
    B.compact(spark, root, AS_OF + 20)
    assert layout.latest_version(spark, root)[1].indexed.keys() == {"tags", "v", "t"}
    whole, f = scan_set(spark, root, as_of=AS_OF + 20), where("t", "=", "t7")
    assert rows_of(scan_set(spark, root, as_of=AS_OF + 20, where=f), "__key") == rows_of(whole.where("t = 't7'"), "__key")


def test_bins_indexed_later(spark, tmp_out):
    root = f"{tmp_out}/later"
    rows = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 200).alias("v"))
    B.write_bucketed(spark, rows, root, spec("later"), buckets=32)
    f = where("v", "=", 7)
    assert len(opened(scan_set(spark, root, as_of=AS_OF, where=f))) == 32
    with pytest.raises(ValueError):
        index_bins(spark, root, ["nothing"])
    index_bins(spark, root, ["v"])
    assert len(opened(scan_set(spark, root, as_of=AS_OF, where=f))) <= 2 and scan_set(spark, root, as_of=AS_OF, where=f).count() == 2
    version = layout.latest_version(spark, root)[0]
    index_bins(spark, root, ["v"])
    assert layout.latest_version(spark, root)[0] == version
    B.write_bucketed(spark, rows.where("k = 3").withColumn("v", F.lit(7).cast("bigint")), root, spec("later"))
    assert rows_of(scan_set(spark, root, as_of=AS_OF, where=f), "k") == [(207,), (3,), (7,)]


def test_a_segment_without_a_finished_index_is_read(spark, tmp_out):
    root = f"{tmp_out}/half"
    B.write_bucketed(spark, spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v")), root, spec("half"), buckets=4, index=("v",))
    m = layout.latest_version(spark, root)[1]
    write = m.segments[0][0].write
    for part in ("items", "zones"):
        layout.delete_path(spark, f"{skipping._folder(root, m.indexed['v'], part)}/w={write}/_SUCCESS")
    assert scan_set(spark, root, as_of=AS_OF, where=where("v", "=", 9)).count() == 1
    assert scan_set(spark, root, as_of=AS_OF, where=where("v", ">", 44)).count() == 5


def test_keys_of_several_types_and_sets_addressed_by_digest(spark, tmp_out):
    root = f"{tmp_out}/types"
    n = spark.range(40).select(F.col("id").alias("k"), F.lit("n").alias("kind"))
    for df in (n, n.select(F.col("k").cast("string").alias("t"), F.lit("t").alias("kind")), n.select(F.col("k").cast("string").cast("binary").alias("b"), F.lit("b").alias("kind"))):
        B.write_bucketed(spark, df, root, spec("types", key_col=df.columns[0]), buckets=32)
    got = scan_set(spark, root, as_of=AS_OF, where=where("__key", "=", "7"))
    assert rows_of(got, "kind") == [("b",), ("n",), ("t",)] and len({b for b, _ in opened(got)}) <= 3
    # Written back by the key the scan gives, records keep their identity, those with binary keys too.
    B.write_bucketed(spark, scan_set(spark, root, as_of=AS_OF).drop("k", "t", "b"), root, spec("types", key_col="__key"))
    assert rows_of(scan_set(spark, root, as_of=AS_OF, where=where("__key", "=", "7")), "kind", "__generation") == [("b", 2), ("n", 2), ("t", 2)]
    own = spark.createDataFrame([("7", bytearray(b"x" * 20), "own")], "__key string, d binary, kind string")
    B.write_bucketed(spark, own, root, W.WriteSpec("types", mode="append", digest_col="d", as_of=AS_OF))
    assert layout.latest_version(spark, root)[1].keyed_as == ""
    whole = scan_set(spark, root, as_of=AS_OF)
    assert rows_of(scan_set(spark, root, as_of=AS_OF, where=where("__key", "=", "7")), "kind") == rows_of(whole.where("__key = '7'"), "kind")


def test_reader_and_renamed_metadata(spark, tmp_out):
    rows = spark.range(30).select(F.col("id").alias("k"), F.array(F.col("id")).alias("tags"))
    writer(rows).mode("append").set("api").key("k").options(namespace=tmp_out, buckets=16, indexBins="tags, k").save(as_of=AS_OF)
    r = reader(spark).options(namespace=tmp_out, keyColumn="id").set("api")
    got = r.load(as_of=AS_OF, where=where("id", "=", 4) | where("tags", "=", 5))
    assert rows_of(got, "id") == [("4",), ("5",)] and len(opened(got)) <= 2
    with pytest.raises(ValueError):
        writer(rows).mode("append").set("bad").key("k").options(namespace=tmp_out, indexBins="none").save(as_of=AS_OF)
    with pytest.raises(ValueError):
        where("k", "like", 3)


def test_postings_are_read_by_pushed_filter(spark, indexed):
    m = layout.latest_version(spark, indexed)[1]
    lookup = skipping._Lookup(spark, indexed, m)
    rows, missing = lookup._read("tags", "items", [skipping.T.StructField("item", skipping.T.LongType()), skipping.T.StructField("buckets", skipping.T.ArrayType(skipping.T.IntegerType()))])
    plan = rows.where(F.col("item").isin([5]))._jdf.queryExecution().executedPlan().toString()
    assert not missing and "PushedFilters: [IsNotNull(item), EqualTo(item,5)]" in plan


def test_old_index_folders_go_with_their_writes(spark, tmp_out):
    root = f"{tmp_out}/gone"
    rows = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("v"))
    for _ in range(3):
        B.write_bucketed(spark, rows, root, spec("gone", mode="overwrite"), buckets=2, index=("v",))
    layout.drop_old_versions(spark, root, keep=1, grace_sec=0)
    live = {s.write for own in layout.latest_version(spark, root)[1].segments.values() for s in own}
    assert {n.removeprefix("w=") for n in layout._names(spark, f"{root}/index/*/*/w=*")} == live
    assert scan_set(spark, root, as_of=AS_OF, where=where("v", "=", 3)).count() == 1
