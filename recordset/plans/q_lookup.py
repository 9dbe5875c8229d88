"""Lookup-join queries (JN-1..4, AGG-9): event keys looked up in the customer set."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.operators import lookup as L
from recordset.plans.data import table, MISS_OFFSET
from recordset.plans.q_scan import customer_set
from recordset.plans.registry import query

# Event keys: user_id, shifted out of range for odd event ids so that some miss.
_KEYS_SQL = f"""
keys AS (SELECT DISTINCT CAST(user_id + CASE WHEN event_id % 2 = 1 THEN {MISS_OFFSET} ELSE 0 END AS VARCHAR) AS k
         FROM events),
found AS (SELECT c.* FROM customer c JOIN keys ON CAST(c.c_custkey AS VARCHAR) = keys.k)
"""


def event_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    shift = F.when(F.col("event_id") % 2 == 1, F.lit(MISS_OFFSET)).otherwise(F.lit(0))
    return e.select((F.col("user_id") + shift).alias("user_key"), "event_id")


@query(
    "lookup_map",
    "WITH " + _KEYS_SQL + """
    SELECT CAST(c_custkey AS VARCHAR) AS key, 'c_mktsegment' AS bin, c_mktsegment AS value FROM found
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_name', c_name FROM found
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM found""",
    ("JN-1", "AGG-9"),
)
def lookup_map_q(spark, sf_dir):
    return L.lookup_map(event_keys(spark, sf_dir), "user_key", customer_set(spark, sf_dir),
                        bins=["c_mktsegment", "c_name", "c_nationkey"])


CUSTOMER_RECORD = T.StructType([
    T.StructField("c_name", T.StringType(), False),
    T.StructField("c_mktsegment", T.StringType(), True),
    T.StructField("c_phone", T.StringType(), True),  # optional field the set lacks -> null
])


@query(
    "lookup_typed",
    "WITH " + _KEYS_SQL + """
    SELECT c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone, CAST(c_custkey AS VARCHAR) AS __key FROM found""",
    ("JN-2", "FN-14"),
)
def lookup_typed_q(spark, sf_dir):
    return L.lookup_typed(event_keys(spark, sf_dir), "user_key", customer_set(spark, sf_dir), CUSTOMER_RECORD)


@query(
    "lookup_broadcast",
    "WITH " + _KEYS_SQL + """
    SELECT CAST(c_custkey AS VARCHAR) AS key, c_name, c_mktsegment, c_nationkey FROM found""",
    ("JN-4",),
)
def lookup_broadcast_q(spark, sf_dir):
    return L.lookup_wide(event_keys(spark, sf_dir), "user_key", customer_set(spark, sf_dir),
                         ["c_name", "c_mktsegment", "c_nationkey"])


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def order_probe(spark, sf_dir):
    """Orders carrying a customer key (half shifted out of range) and a derived segment."""
    o = table(spark, sf_dir, "orders")
    seg = F.element_at(F.array(*[F.lit(s) for s in _SEGMENTS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    shift = F.when(F.col("o_orderkey") % 2 == 1, F.lit(MISS_OFFSET)).otherwise(F.lit(0))
    return o.select("o_orderkey", (F.col("o_custkey") + shift).alias("c_custkey"), seg.alias("c_mktsegment"))


_SEG_LIST = ", ".join(f"'{s}'" for s in _SEGMENTS)


@query(
    "intersect_match",
    f"""WITH d AS (
      SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 2 = 1 THEN {MISS_OFFSET} ELSE 0 END AS c_custkey,
             [{_SEG_LIST}][o_orderkey % 5 + 1] AS c_mktsegment FROM orders)
    SELECT d.o_orderkey, d.c_custkey, d.c_mktsegment FROM d
      LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = CAST(d.c_custkey AS VARCHAR)
     WHERE c.c_custkey IS NULL
        OR (c.c_custkey = d.c_custkey AND (c.c_mktsegment IS NULL OR c.c_mktsegment = d.c_mktsegment))""",
    ("JN-3",),
)
def intersect_match_q(spark, sf_dir):
    target = customer_set(spark, sf_dir).select("__key", "__digest", "__expiry", "__generation", "__ttl",
                                                  "c_custkey", "c_mktsegment")
    return L.intersect_match(order_probe(spark, sf_dir), "c_custkey", target)
