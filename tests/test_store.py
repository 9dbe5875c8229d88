"""SRC-1, SRC-3, SRC-4, SRC-5, SRC-8, SRC-9, SRC-13, SNK-13; FN-12, FN-13 on the 'things' fixture."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from recordset.options import resolve
from recordset.sources import store as S

AS_OF = 1_000


def things(spark):
    # key rdd-test-<i>; one BIGINT, two STRING, three DOUBLE; TTL 600 (FIXTURES.md)
    rows = [Row(key=f"rdd-test-{i}", one=i, two=f"two:{i}", three=float(i)) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "key string, one bigint, two string, three double")
    return S.as_set(df, "rdd-test", "key", expiry=F.lit(AS_OF + 600))


def test_scan_metadata_columns(spark):
    v = S.scan_view(things(spark), AS_OF)
    assert v.columns[:5] == ["__key", "__digest", "__expiry", "__generation", "__ttl"]
    assert v.columns[5:] == sorted(["key", "one", "two", "three"])
    r = v.where("one = 1").first()
    assert r["__ttl"] == 600 and r["__generation"] == 1 and len(r["__digest"]) == 20
    assert v.count() == 100


def test_filters_equal_and_between(spark):
    v = S.scan_view(things(spark), AS_OF)
    assert v.where(F.col("one") == 55).count() == 1
    assert v.where(F.col("one").between(55, 65)).count() == 11  # inclusive
    assert v.where(F.col("two") == "two:55").first()["one"] == 55


def test_renamed_metadata(spark):
    o = resolve(keyColumn="k", ttlColumn="left")
    v = S.scan_view(things(spark), AS_OF, o)
    assert "k" in v.columns and "left" in v.columns and "__key" not in v.columns


def test_expired_records_invisible(spark):
    t = things(spark)
    assert S.scan_view(t, AS_OF + 599, live_only=True).count() == 100
    assert S.scan_view(t, AS_OF + 600, live_only=True).count() == 0


def test_never_expiring_ttl_is_minus_one(spark):
    df = spark.createDataFrame([Row(k=1)])
    v = S.scan_view(S.as_set(df, "s", "k"), AS_OF)
    assert v.first()["__ttl"] == -1 and v.first()["__expiry"] == 0


def test_digest_depends_on_set_and_key_type(spark):
    df = spark.createDataFrame([Row(k=1, s="1")])
    a = df.select(S.digest("a", "k", df.schema["k"].dataType).alias("d")).first()["d"]
    b = df.select(S.digest("b", "k", df.schema["k"].dataType).alias("d")).first()["d"]
    c = df.select(S.digest("a", "s", df.schema["s"].dataType).alias("d")).first()["d"]
    assert a != b and a != c and len(a) == 20


def test_scan_set_pushdown_and_pruning(spark, tmp_out):
    path = f"{tmp_out}/things"
    things(spark).write.parquet(path)
    v = S.scan_set(spark, path, as_of=AS_OF, live_only=False)
    q = v.where((F.col("one") > 10) & F.col("two").startswith("two:1")).select("one")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(one,10)" in plan and "StringStartsWith(two,two:1)" in plan
    assert "ReadSchema: struct<one:bigint,two:string>" in plan
    assert q.count() == 10  # 11..19 and 100


def test_scan_set_plain_table_needs_key(spark, tmp_out):
    import pytest

    path = f"{tmp_out}/plain"
    spark.createDataFrame([Row(a=1)]).write.parquet(path)
    with pytest.raises(ValueError):
        S.scan_set(spark, path, as_of=0)
    assert S.scan_set(spark, path, as_of=0, key_col="a").first()["__key"] == "1"


def test_sql_over_view(spark):
    S.scan_view(things(spark), AS_OF).createOrReplaceTempView("things_view")
    assert spark.sql("SELECT count(*) AS n FROM things_view WHERE one BETWEEN 1 AND 10").first()["n"] == 10


def test_bins_only(spark):
    assert S.bins_only(S.scan_view(things(spark), AS_OF)).columns == ["key", "one", "three", "two"]
