"""JN-1..4, AGG-9: lookups and the intersect match (selector fixtures)."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.operators import lookup as L
from recordset.sources import store as S

NAMES = ["jack", "jill", "james", "jim", "julie"]
COLORS = ["blue", "red", "yellow", "green", "purple"]
ANIMALS = ["cat", "dog", "mouse", "snake", "lion"]


def selector(spark, int_keys=True):
    rows = []
    for x in range(1, 101):
        p = (x - 1) % 5
        rows.append(Row(key=x if int_keys else f"selector-test:{x}", name=NAMES[p], color=COLORS[p],
                        animal=ANIMALS[p], age=p * 10 + 20))
    df = spark.createDataFrame(rows)
    return S.scan_view(S.as_set(df, "selector", "key"), as_of=0)


@pytest.mark.parametrize("bound", [True, False])  # broadcast path, shuffle path
def test_lookup_hits(spark, bound):
    target = selector(spark)
    ds = spark.createDataFrame([Row(a=1, b=2), Row(a=3, b=4)])
    got = L.lookup_wide(ds, "a", target, ["name", "age"], small=bound)
    assert sorted((r.key, r.name) for r in got.collect()) == [("1", "jack"), ("3", "james")]
    one = spark.createDataFrame([Row(a=1, b=2), Row(a=1000, b=4)])
    assert L.lookup_wide(one, "a", target, ["name"], small=bound).count() == 1
    none = spark.createDataFrame([Row(a=1000, b=2), Row(a=2000, b=4)])
    assert L.lookup_wide(none, "a", target, ["name"], small=bound).count() == 0


def test_lookup_map_dedupes_and_drops_null_bins(spark):
    target = selector(spark).withColumn("color", F.when(F.col("key") == 2, None).otherwise(F.col("color")))
    ds = spark.createDataFrame([Row(a=2), Row(a=2), Row(a=2)])
    got = sorted((r.bin, r.value) for r in L.lookup_map(ds, "a", target, ["name", "color"]).collect())
    assert got == [("name", "jill")]


def test_lookup_empty_dataset(spark):
    ds = spark.createDataFrame([], "a bigint")
    assert L.lookup_map(ds, "a", selector(spark)).count() == 0


def test_typed_lookup_required_field(spark):
    target = selector(spark)
    ds = spark.createDataFrame([Row(a=1)])
    rec = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("nick", T.StringType(), True)])
    r = L.lookup_typed(ds, "a", target, rec).first()
    assert r.name == "jack" and r.nick is None and r["__key"] == "1"
    strict = T.StructType([T.StructField("nick", T.StringType(), False)])
    with pytest.raises(Exception, match="missing required field nick"):
        L.lookup_typed(ds, "a", target, strict).collect()


@pytest.mark.parametrize("bound", [True, False])
def test_intersect(spark, bound):
    target = selector(spark, int_keys=False).select(*S.META, "key", "color", "name", "animal", "age")
    ds = spark.createDataFrame([
        Row(key="selector-test:1", color="blue", name="jack", animal="cat", age=20),   # matches
        Row(key="selector-test:2", color="blue", name="jill", animal="dog", age=30),   # color differs
        Row(key="selector-test:999", color="x", name="y", animal="z", age=1),          # not found: kept
        Row(key="selector-test:1", color="blue", name="jack", animal="cat", age=20),   # duplicate kept
    ])
    got = L.intersect_match(ds, "key", target, small=bound)
    assert sorted(r.key for r in got.collect()) == ["selector-test:1", "selector-test:1", "selector-test:999"]
    strict = L.intersect_match(ds, "key", target, keep_unmatched=False, small=bound)
    assert strict.count() == 2


def test_intersect_numeric_by_value_and_missing_field(spark):
    target = selector(spark, int_keys=False).select(*S.META, "key", "age")
    ds = spark.createDataFrame([Row(key="selector-test:1", age=20)], "key string, age int")  # int vs bigint
    assert L.intersect_match(ds, "key", target).count() == 1
    with pytest.raises(ValueError):
        L.intersect_match(ds.drop("age"), "key", target)


def test_lookup_plan(spark):
    target = selector(spark)
    ds = spark.createDataFrame([Row(a=1)])
    known = L.fetch(ds, "a", target, small=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in known
    assert len(L.fetch(ds, "a", target).collect()) == 1


def test_found_key_without_bins_stays(spark):
    target = spark.createDataFrame([("1", None), ("2", "x")], "__key string, b string")
    ds = spark.createDataFrame([("1",), ("2",), ("3",)], "k string")
    assert sorted(map(str, map(tuple, L.lookup_map(ds, "k", target, ["b"]).collect()))) == ["('1', None, None)", "('2', 'b', 'x')"]


def test_required_field_is_checked_under_count(spark):
    target = spark.createDataFrame([("1", None)], "__key string, b string")
    record = T.StructType([T.StructField("b", T.StringType(), False)])
    with pytest.raises(Exception, match="missing required field b"):
        L.lookup_typed(spark.createDataFrame([("1",)], "k string"), "k", target, record).count()
