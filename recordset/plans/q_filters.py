"""Filter queries (FLT-1..14, FN-10, FN-11) over the customer and orders sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordset.operators import predicates as P
from recordset.plans.q_scan import customer_set, orders_set
from recordset.plans.data import table
from recordset.plans.registry import query


@query("filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'", ("FLT-1",))
def filter_eq_q(spark, sf_dir):
    c = customer_set(spark, sf_dir)
    return c.where(P.bin_eq(c, "c_mktsegment", "BUILDING")).select("c_custkey", "c_name")


_RANGE_CASES = [(">=", 400000.0, "ge"), (">", 400000.0, "gt"), ("<=", 20000.0, "le"), ("<", 20000.0, "lt")]


@query(
    "filter_range",
    " UNION ALL ".join(
        f"SELECT '{lab}' AS case_name, o_orderkey FROM orders WHERE o_totalprice {op} {v}" for op, v, lab in _RANGE_CASES
    ),
    ("FLT-4", "FLT-5", "FLT-6", "FLT-7"),
)
def filter_range_q(spark, sf_dir):
    o = orders_set(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [o.where(P.compare("o_totalprice", op, v)).select(F.lit(lab).alias("case_name"), "o_orderkey") for op, v, lab in _RANGE_CASES],
    )


@query(
    "filter_between",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000",
    ("FLT-8",),
)
def filter_between_q(spark, sf_dir):
    return orders_set(spark, sf_dir).where(P.between("o_totalprice", 100000, 150000)).select("o_orderkey", "o_totalprice")


@query("filter_prefix", "SELECT c_custkey, c_name FROM customer WHERE starts_with(c_name, 'Customer#0000001')", ("FLT-9",))
def filter_prefix_q(spark, sf_dir):
    return customer_set(spark, sf_dir).where(P.starts_with("c_name", "Customer#0000001")).select("c_custkey", "c_name")


@query("filter_suffix", "SELECT c_custkey, c_name FROM customer WHERE ends_with(c_name, '7')", ("FLT-10",))
def filter_suffix_q(spark, sf_dir):
    return customer_set(spark, sf_dir).where(P.ends_with("c_name", "7")).select("c_custkey", "c_name")


def _with_sparse_bin(spark, sf_dir):
    # A bin missing from some records: the segment, absent for AUTOMOBILE customers.
    return customer_set(spark, sf_dir).withColumn("segment", F.expr("nullif(c_mktsegment, 'AUTOMOBILE')"))


@query(
    "filter_not_null",
    "SELECT c_custkey, nullif(c_mktsegment, 'AUTOMOBILE') AS segment FROM customer "
    "WHERE nullif(c_mktsegment, 'AUTOMOBILE') IS NOT NULL",
    ("FLT-11",),
)
def filter_not_null_q(spark, sf_dir):
    return _with_sparse_bin(spark, sf_dir).where(P.present("segment")).select("c_custkey", "segment")


@query(
    "filter_and_or",
    "SELECT c_custkey FROM customer WHERE (c_mktsegment = 'BUILDING' AND c_acctbal > 5000) OR c_nationkey = 3",
    ("FLT-12", "FLT-13"),
)
def filter_and_or_q(spark, sf_dir):
    c = customer_set(spark, sf_dir)
    pred = P.any_of(
        P.all_of(P.bin_eq(c, "c_mktsegment", "BUILDING"), P.compare("c_acctbal", ">", 5000.0)),
        P.compare("c_nationkey", "=", 3),
    )
    return c.where(pred).select("c_custkey")


@query(
    "filter_residual",
    """SELECT 'in' AS case_name, c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3)
       UNION ALL SELECT 'not', c_custkey FROM customer WHERE NOT (c_mktsegment = 'BUILDING')
       UNION ALL SELECT 'is_null', c_custkey FROM customer WHERE nullif(c_mktsegment, 'AUTOMOBILE') IS NULL
       UNION ALL SELECT 'contains', c_custkey FROM customer WHERE contains(c_name, '99')
       UNION ALL SELECT 'null_safe', c_custkey FROM customer
                 WHERE nullif(c_mktsegment, 'AUTOMOBILE') IS NOT DISTINCT FROM 'MACHINERY'""",
    ("FLT-14",),
)
def filter_residual_q(spark, sf_dir):
    c = _with_sparse_bin(spark, sf_dir)
    cases = [
        ("in", F.col("c_nationkey").isin(1, 2, 3)),
        ("not", ~(F.col("c_mktsegment") == "BUILDING")),
        ("is_null", F.col("segment").isNull()),
        ("contains", F.col("c_name").contains("99")),
        ("null_safe", F.col("segment").eqNullSafe("MACHINERY")),
    ]
    return reduce(DataFrame.unionByName, [c.where(p).select(F.lit(n).alias("case_name"), "c_custkey") for n, p in cases])


def customer_order_bins(spark, sf_dir):
    """Per customer: list bin of order years, map bin priority -> order count.

    Both collections are bounded (distinct years, five priorities), so no
    group is gathered whole however many orders a customer has.
    """
    o = table(spark, sf_dir, "orders")
    years = o.groupBy("o_custkey").agg(F.array_sort(F.collect_set(F.year("o_orderdate"))).alias("order_years"))
    prio = (
        o.groupBy("o_custkey", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("o_custkey")
        .agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "n"))).alias("priority_counts"))
    )
    return years.join(prio, "o_custkey").withColumnRenamed("o_custkey", "c_custkey")


@query(
    "filter_list_contains",
    "SELECT o_custkey AS c_custkey FROM orders GROUP BY o_custkey HAVING count(*) FILTER (WHERE year(o_orderdate) = 1997) > 0",
    ("FLT-2",),
)
def filter_list_contains_q(spark, sf_dir):
    b = customer_order_bins(spark, sf_dir)
    return b.where(P.bin_eq(b, "order_years", 1997)).select("c_custkey")


@query(
    "filter_map_key",
    "SELECT o_custkey AS c_custkey FROM orders GROUP BY o_custkey HAVING count(*) FILTER (WHERE o_orderpriority = '5-LOW') > 0",
    ("FLT-3",),
)
def filter_map_key_q(spark, sf_dir):
    b = customer_order_bins(spark, sf_dir)
    return b.where(P.bin_eq(b, "priority_counts", "5-LOW")).select("c_custkey")


@query(
    "list_access",
    "SELECT o_custkey AS c_custkey, min(year(o_orderdate)) AS first_year, "
    "CAST(count(DISTINCT year(o_orderdate)) AS INTEGER) AS n_years FROM orders GROUP BY o_custkey",
    ("FN-10",),
)
def list_access_q(spark, sf_dir):
    b = customer_order_bins(spark, sf_dir)
    return b.select("c_custkey", P.list_first("order_years").alias("first_year"), P.list_size("order_years").alias("n_years"))


@query(
    "map_access",
    """SELECT o_custkey AS c_custkey,
              CASE WHEN count(*) FILTER (WHERE o_orderpriority = '1-URGENT') = 0 THEN -1
                   ELSE count(*) FILTER (WHERE o_orderpriority = '1-URGENT') END AS n_urgent,
              count(*) FILTER (WHERE o_orderpriority = '5-LOW') > 0 AS has_low
         FROM orders GROUP BY o_custkey""",
    ("FN-11",),
)
def map_access_q(spark, sf_dir):
    b = customer_order_bins(spark, sf_dir)
    return b.select(
        "c_custkey",
        P.map_get_or("priority_counts", "1-URGENT", -1).alias("n_urgent"),
        P.map_has("priority_counts", "5-LOW").alias("has_low"),
    )
