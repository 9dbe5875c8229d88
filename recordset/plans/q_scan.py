"""Scan, metadata and limit queries (SRC-1..5, SRC-8, SRC-9, SRC-13, FLT-15, FN-12, FN-13, LIM-1, LIM-2, AGG-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordset.plans.data import table, AS_OF_SEC
from recordset.plans.registry import query
from recordset.sources import store as S

CUST_BINS = "c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey"


def customer_set(spark, sf_dir, live_only=False, **opts):
    return S.scan_set(spark, "customer.parquet", namespace=sf_dir, key_col="c_custkey", as_of=AS_OF_SEC,
                      live_only=live_only, **opts)


def orders_set(spark, sf_dir):
    return S.scan_set(spark, "orders.parquet", namespace=sf_dir, key_col="o_orderkey", as_of=AS_OF_SEC)


def synthetic_customer_set(spark, sf_dir, customers=None):
    """Customer (or the given rows of it) as a stored set with varied generation and expiry."""
    c = table(spark, sf_dir, "customer") if customers is None else customers
    k = F.col("c_custkey")
    gen = 1 + k % 3
    expiry = F.when(k % 7 == 2, F.lit(0)).otherwise(F.lit(AS_OF_SEC) + (k % 7 - 2) * 100)
    return S.as_set(c, "customer", "c_custkey", generation=gen, expiry=expiry)


_DIGEST_SQL = "lower(sha1('customer:L:' || CAST(c_custkey AS VARCHAR)))"
_SYN_SQL = f"""
WITH syn AS (
  SELECT CAST(c_custkey AS VARCHAR) AS __key, {_DIGEST_SQL} AS __digest,
         CAST(CASE WHEN c_custkey % 7 = 2 THEN 0 ELSE {AS_OF_SEC} + (c_custkey % 7 - 2) * 100 END AS INTEGER) AS __expiry,
         CAST(1 + c_custkey % 3 AS INTEGER) AS __generation, c_name, c_custkey
  FROM customer),
meta AS (
  SELECT *, CAST(CASE WHEN __expiry = 0 THEN -1 ELSE __expiry - {AS_OF_SEC} END AS INTEGER) AS __ttl FROM syn)
"""


@query(
    "scan_set",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS __key, {_DIGEST_SQL} AS __digest, CAST(0 AS INTEGER) AS __expiry,
           CAST(1 AS INTEGER) AS __generation, CAST(-1 AS INTEGER) AS __ttl, {CUST_BINS} FROM customer""",
    ("SRC-1", "SRC-2", "SRC-3"),
)
def scan_set_q(spark, sf_dir):
    return customer_set(spark, sf_dir).withColumn("__digest", S.digest_hex("__digest"))


@query("set_count", "SELECT count(*) AS n FROM orders", ("AGG-1",))
def set_count_q(spark, sf_dir):
    return orders_set(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query("pruned_scan", "SELECT o_orderkey, o_totalprice FROM orders", ("SRC-8", "PRJ-1"))
def pruned_scan_q(spark, sf_dir):
    return orders_set(spark, sf_dir).select("o_orderkey", "o_totalprice")


_PUSH_SQL = ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders "
             "WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")


@query("pushdown_scan", _PUSH_SQL, ("SRC-9", "FLT-1", "FLT-5", "FLT-12"))
def pushdown_scan_q(spark, sf_dir):
    return (
        orders_set(spark, sf_dir)
        .where((F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F"))
        .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    )


@query("sql_over_view", _PUSH_SQL, ("SRC-13",))
def sql_over_view_q(spark, sf_dir):
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM {orders} "
        "WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
        orders=orders_set(spark, sf_dir),
    )


@query(
    "record_metadata",
    _SYN_SQL + "SELECT __key, __digest, __expiry, __generation, __ttl, c_name FROM meta",
    ("SRC-3", "FN-12", "FN-13"),
)
def record_metadata_q(spark, sf_dir):
    v = S.scan_view(synthetic_customer_set(spark, sf_dir), AS_OF_SEC)
    return v.select("__key", S.digest_hex("__digest").alias("__digest"), "__expiry", "__generation", "__ttl", "c_name")


@query(
    "metadata_renamed",
    _SYN_SQL + """SELECT __key AS id, __digest AS hash, __expiry AS expires, __generation AS gen,
                         __ttl AS time_left, c_name FROM meta""",
    ("SRC-4",),
)
def metadata_renamed_q(spark, sf_dir):
    from recordset.options import resolve

    opts = resolve(keyColumn="id", digestColumn="hash", expiryColumn="expires", generationColumn="gen", ttlColumn="time_left")
    v = S.scan_view(synthetic_customer_set(spark, sf_dir), AS_OF_SEC, opts)
    return v.select("id", S.digest_hex("hash").alias("hash"), "expires", "gen", "time_left", "c_name")


@query(
    "live_records",
    _SYN_SQL + f"SELECT __key, __ttl, c_name FROM meta WHERE __expiry = 0 OR __expiry > {AS_OF_SEC}",
    ("SRC-5",),
)
def live_records_q(spark, sf_dir):
    v = S.scan_view(synthetic_customer_set(spark, sf_dir), AS_OF_SEC, live_only=True)
    return v.select("__key", "__ttl", "c_name")


@query(
    "filter_metadata",
    _SYN_SQL + "SELECT __key, __generation, __ttl FROM meta WHERE __generation = 2 AND __ttl > 100",
    ("FLT-15",),
)
def filter_metadata_q(spark, sf_dir):
    v = S.scan_view(synthetic_customer_set(spark, sf_dir), AS_OF_SEC)
    return v.where((F.col("__generation") == 2) & (F.col("__ttl") > 100)).select("__key", "__generation", "__ttl")


@query(
    "take_n",
    "SELECT CAST(c_custkey AS VARCHAR) AS __key, c_name FROM customer ORDER BY c_custkey LIMIT 50",
    ("LIM-1",),
)
def take_n_q(spark, sf_dir):
    # A top-n report: ordering makes it checkable; Spark plans TakeOrderedAndProject.
    return customer_set(spark, sf_dir).orderBy("c_custkey").limit(50).select("__key", "c_name")


@query(
    "first_match",
    "SELECT CAST(c_custkey AS VARCHAR) AS __key, c_name, c_mktsegment FROM customer "
    "WHERE c_mktsegment = 'MACHINERY' ORDER BY c_custkey LIMIT 1",
    ("LIM-2",),
)
def first_match_q(spark, sf_dir):
    return (
        customer_set(spark, sf_dir)
        .where(F.col("c_mktsegment") == "MACHINERY")
        .orderBy("c_custkey")
        .limit(1)
        .select("__key", "c_name", "c_mktsegment")
    )
