"""SNK-1, SNK-3..17: keyed writes, per-record modes, generations, TTL, outcomes."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from recordset.operators import keyed_write as W
from recordset.sources import store as S

AS_OF = 10_000


def people(spark):
    # key, last, first, when, ttl (FIXTURES.md "people"), stored as a set
    rows = [Row(key=f"p{i}", last=f"L{i}", first=f"F{i}", when=i * 100) for i in range(1, 9)]
    return S.as_set(spark.createDataFrame(rows), "people", "key", generation=F.lit(3))


def inc(spark, rows, schema="key string, first string, __generation int"):
    return spark.createDataFrame(rows, schema)


def spec(mode, **kw):
    return W.WriteSpec("people", mode=mode, key_col="key", as_of=AS_OF, **kw)


def as_dict(df):
    return {r["__key"]: r.asDict() for r in df.collect()}


@pytest.fixture(params=[True, False], ids=["broadcast", "shuffle"])
def bound(request):
    return request.param


def test_ignore_keeps_existing_creates_new(spark, bound):
    out = as_dict(W.merge(people(spark), inc(spark, [("p1", "X", 3), ("p9", "N", 0)]), spec("ignore"), bound))
    assert out["p1"]["first"] == "F1" and out["p1"]["__generation"] == 3
    assert out["p9"]["first"] == "N" and out["p9"]["last"] is None and out["p9"]["__generation"] == 1
    assert len(out) == 9


def test_errorifexists(spark, bound):
    with pytest.raises(W.WriteConflict), W.conflicts_raised():
        W.merge(people(spark), inc(spark, [("p1", "X", 3)]), spec("errorifexists"), bound).count()
    out = as_dict(W.merge(people(spark), inc(spark, [("p9", "N", 0)]), spec("errorifexists"), bound))
    assert "p9" in out
    c = W.conflicts(people(spark), inc(spark, [("p1", "X", 3), ("p9", "N", 0)]), spec("ignore"))
    assert [r["__key"] for r in c.collect()] == ["p1"]


def test_replace_drops_unwritten_bins(spark, bound):
    out = as_dict(W.merge(people(spark), inc(spark, [("p2", "X", 3)]), spec("overwrite"), bound))
    assert out["p2"]["first"] == "X" and out["p2"]["last"] is None and out["p2"]["when"] is None
    assert out["p2"]["__generation"] == 4 and out["p3"]["last"] == "L3"


def test_upsert_merges_and_null_removes(spark, bound):
    rows = [("p2", "X", 3), ("p3", None, 3), ("p10", "N", 0)]
    out = as_dict(W.merge(people(spark), inc(spark, rows), spec("append"), bound))
    assert out["p2"]["first"] == "X" and out["p2"]["last"] == "L2"
    assert out["p3"]["first"] is None and out["p3"]["last"] == "L3"  # null bin removed, others kept
    assert out["p10"]["__generation"] == 1


def test_update_only_skips_missing(spark, bound):
    out = as_dict(W.merge(people(spark), inc(spark, [("p2", "X", 3), ("p10", "N", 0)]), spec("update_only"), bound))
    assert "p10" not in out and out["p2"]["first"] == "X" and len(out) == 8


def test_generation_check(spark, bound):
    rows = [("p1", "ok", 3), ("p2", "stale", 2), ("p11", "new-bad", 1), ("p12", "new-ok", 0)]
    sp = spec("append", generation_policy="expect_gen_equal")
    out = as_dict(W.merge(people(spark), inc(spark, rows), sp))
    assert out["p1"]["first"] == "ok" and out["p1"]["__generation"] == 4
    assert out["p2"]["first"] == "F2"
    assert "p11" not in out and out["p12"]["first"] == "new-ok"
    oc = {r["__key"]: r.outcome for r in W.classify(people(spark), inc(spark, rows), sp).collect()}
    assert oc == {"p1": "updated", "p2": "generation_conflict", "p11": "generation_conflict", "p12": "created"}


def test_ttl_column(spark, bound):
    rows = [("p1", "a", 3, 600), ("p20", "b", 0, -1), ("p21", "c", 0, 0)]
    df = inc(spark, rows, "key string, first string, __generation int, ttl int")
    out = as_dict(W.merge(people(spark), df, spec("append", ttl_col="ttl"), bound))
    assert out["p1"]["__expiry"] == AS_OF + 600
    assert out["p20"]["__expiry"] == 0 and out["p21"]["__expiry"] == 0
    assert "ttl" not in out["p1"]


def test_expired_record_counts_as_absent(spark, bound):
    t = people(spark).withColumn("__expiry", F.when(F.col("__key") == "p1", F.lit(AS_OF - 1)).otherwise(F.lit(0)))
    out = as_dict(W.merge(t, inc(spark, [("p1", "new", 0)]), spec("ignore"), bound))
    assert out["p1"]["first"] == "new" and out["p1"]["__generation"] == 1


def test_duplicate_keys(spark, bound):
    rows = [("p1", "a", 3, 1), ("p1", "b", 3, 2)]
    df = inc(spark, rows, "key string, first string, __generation int, seq int")
    with pytest.raises(Exception, match="repeat a key"):
        W.merge(people(spark), df, spec("append"), bound).collect()
    last = as_dict(W.merge(people(spark), df, spec("append", order_by="seq"), bound))
    assert last["p1"]["first"] == "b"
    first = as_dict(W.merge(people(spark), df.withColumn("key", F.lit("p50")), spec("ignore", order_by="seq"), bound))
    assert first["p50"]["first"] == "a"


def test_by_digest(spark, bound):
    t = people(spark)
    d = t.where("__key = 'p4'").select(F.col("__digest").alias("dg"), F.lit("viaDigest").alias("first"))
    out = as_dict(W.merge(t, d, W.WriteSpec("people", mode="append", digest_col="dg", as_of=AS_OF), bound))
    assert out["p4"]["first"] == "viaDigest" and out["p4"]["last"] == "L4"


def test_type_normalisation_on_write(spark):
    df = spark.createDataFrame([("p30", 5, 1.5)], "key string, n int, f float")
    out = W.merge(people(spark), df, spec("append"))
    assert dict(out.dtypes)["n"] == "bigint" and dict(out.dtypes)["f"] == "double"


def test_save_set_new_folder(spark, tmp_out):
    src, dst = f"{tmp_out}/v1", f"{tmp_out}/v2"
    people(spark).write.parquet(src)
    with pytest.raises(ValueError):
        W.save_set(spark, src, inc(spark, [("p1", "x", 3)]), src, spec("append"))
    new = W.save_set(spark, src, inc(spark, [("p1", "x", 3)]), dst, spec("append"))
    assert new.count() == 8 and new.where("__key = 'p1'").first()["first"] == "x"
    assert spark.read.parquet(src).where("__key = 'p1'").first()["first"] == "F1"


def test_write_plans(spark, tmp_out):
    """One shuffle a side in the general plan; none of the target when the caller knows the incoming rows to be few."""
    path = f"{tmp_out}/big"
    people(spark).write.parquet(path)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    new = inc(spark, [("p1", "x", 3)])
    few = W.merge(spark.read.parquet(path), new, spec("append"), small=True)
    general = W.merge(spark.read.parquet(path), new, spec("errorifexists"))
    built = jobs.getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "FullOuter" not in plan
    plan = general._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count(" Sort [") == 2 and "SortAggregate" not in plan
    assert len(built) <= 2  # reading a schema, nothing else


def test_versioned_set_with_lists_and_maps(spark, tmp_out):
    """SNK-2, SRC-12, ListTest/MapTest: array and map bins written by key, read back, updated."""
    import random

    from recordset.sources.layout import latest_version
    from recordset.sources.store import scan_set

    rnd = random.Random(300)
    rows = [(f"k{i}", f"L{i}", [rnd.randint(250, 449) for _ in range(3)], {"index-1": rnd.randint(250, 449)}, 600)
            for i in range(8)]
    df = spark.createDataFrame(rows, "key string, last string, things array<int>, tmap map<string,int>, __ttl int")
    W.write_set(spark, df, "people_list", "key", namespace=tmp_out, as_of=AS_OF, mode="append")
    v = scan_set(spark, "people_list", namespace=tmp_out, as_of=AS_OF)
    assert v.count() == 8 and dict(v.dtypes)["things"] == "array<bigint>" and dict(v.dtypes)["tmap"] == "map<string,bigint>"
    r = v.where("__key = 'k0'").first()
    assert r["things"] == rows[0][2] and r["tmap"] == rows[0][3] and r["__ttl"] == 600
    upd = spark.createDataFrame([("k0", [1])], "key string, things array<int>")
    spark.conf.set("recordset.saveMode", "update_only")
    try:
        W.write_set(spark, upd, "people_list", "key", namespace=tmp_out, as_of=AS_OF)
    finally:
        spark.conf.unset("recordset.saveMode")
    n, _ = latest_version(spark, f"{tmp_out}/people_list")
    v2 = scan_set(spark, "people_list", namespace=tmp_out, as_of=AS_OF).where("__key = 'k0'").first()
    assert n == 2 and v2["things"] == [1] and v2["last"] == "L0" and v2["__generation"] == 2


def test_save_by_class(spark, tmp_out):
    class Data:
        pass

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "a int, b string")
    out = W.save_by_class(spark, df, Data, "a", namespace=tmp_out, as_of=AS_OF)
    assert out.count() == 3 and sorted(r["__key"] for r in out.collect()) == ["1", "2", "3"]


def test_drop_old_versions(spark, tmp_out):
    from recordset.sources.layout import drop_old_versions, latest_version
    from recordset.sources.store import scan_set

    for i in range(4):
        df = spark.createDataFrame([("k", i)], "key string, v int")
        W.write_set(spark, df, "hist", "key", namespace=tmp_out, as_of=AS_OF, mode="append")
    root = f"{tmp_out}/hist"
    dropped = drop_old_versions(spark, root, keep=2, grace_sec=0)
    assert len(dropped) == 4 and latest_version(spark, root)[0] == 4
    r = scan_set(spark, root, as_of=AS_OF).first()
    assert r["v"] == 3 and r["__generation"] == 4


def test_drop_old_versions_spares_writes_in_progress(spark, tmp_out):
    import os

    from recordset.sources.layout import drop_old_versions, latest_version

    root = f"{tmp_out}/hist2"
    df = spark.createDataFrame([("k", 1)], "key string, v int")
    W.write_set(spark, df, "hist2", "key", namespace=tmp_out, as_of=AS_OF, mode="append")
    os.makedirs(f"{root}/data/w=unnamed")  # a write that did not publish yet, or failed
    W.write_set(spark, df, "hist2", "key", namespace=tmp_out, as_of=AS_OF, mode="append")
    assert latest_version(spark, root)[0] == 2
    assert drop_old_versions(spark, root, keep=2) == []
    assert [os.path.basename(p) for p in drop_old_versions(spark, root, keep=2, grace_sec=0)] == ["w=unnamed"]


def test_classify_many_equals_single(spark, bound):
    rows = [("p1", "ok", 3), ("p2", "stale", 2), ("p11", "new", 0)]
    specs = {m: spec(m) for m in ("ignore", "overwrite", "append", "update_only")}
    specs["append+gen"] = spec("append", generation_policy="expect_gen_equal")
    many = {(r.label, r["__key"]): r.outcome for r in W.classify_many(people(spark), inc(spark, rows), specs, bound).collect()}
    single = {(label, r["__key"]): r.outcome for label, sp in specs.items()
              for r in W.classify(people(spark), inc(spark, rows), sp).collect()}
    assert many == single and len(many) == 15
    with pytest.raises(ValueError):
        W.classify_many(people(spark), inc(spark, rows), {"a": spec("append"), "b": spec("append", ttl_col="x")})
