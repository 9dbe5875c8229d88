"""A key holding a third of the rows: results stay whole and the hot partition is split."""

from pyspark.sql import functions as F

from recordset.operators import lookup as L
from recordset.sources import store as S


def test_hot_key_intersect_and_lookup(spark):
    target = S.scan_view(S.as_set(spark.range(1000).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("v")), "hot", "k"), as_of=0).drop("k")
    # 40% of the dataset rows carry key 3.
    ds = spark.range(20_000).select(
        F.when(F.col("id") % 5 < 2, F.lit(3)).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") % 7).alias("v"))
    want = L.intersect_match(ds, "k", target).groupBy("k").count()
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got_df = L.intersect_match(ds, "k", target, small=False)
        got = {r["k"]: r["count"] for r in got_df.groupBy("k").count().collect()}
        got_df.collect()  # runs this DataFrame's own adaptive plan to its final form
        plan = got_df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {r["k"]: r["count"] for r in want.collect()}
    key = [3 if i % 5 < 2 else i % 1000 for i in range(20_000)]
    assert got[3] == sum(1 for i in range(20_000) if key[i] == 3 and i % 7 == 3)  # hot key kept whole
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan

    # Distinct keys collapse a hot key map-side: the lookup result has one row per key.
    assert L.lookup_wide(ds, "k", target, ["v"]).where("key = '3'").count() == 1
