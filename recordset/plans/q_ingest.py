"""Delimited-ingest queries (SRC-11, PRJ-4, FN-6..9, FLT-19).

Quoted comma-separated lines are made from orders (with a header line, some
empty prices and departure times, and ``2400`` times), written as text files and read
from there; the oracle reads orders directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from recordset.functions import parse as P
from recordset.session import scratch_folder
from recordset.sources.ingest import ingest_delimited, read_lines
from recordset.plans.data import table
from recordset.plans.registry import query

HEADER = '"o_orderkey","o_custkey","o_orderstatus","o_totalprice","o_orderdate","dep_time"'

FIELDS = [
    ("o_orderkey", lambda c: c.try_cast("bigint")),
    ("o_custkey", P.parse_int),
    ("o_orderstatus", lambda c: c),
    ("o_totalprice", P.parse_double_or_zero),
    ("o_orderdate", lambda c: c),
    ("dep_time", lambda c: c),
]


def order_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.when(k % 10 == 0, F.lit("")).otherwise(F.col("o_totalprice").cast("string"))
    dep = (
        F.when(k % 13 == 0, F.lit(""))
        .when(k % 25 == 24, F.lit("2400"))
        .otherwise(F.lpad(((k % 24) * 100 + k % 60).cast("string"), 4, "0"))
    )
    vals = [k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"), price,
            F.to_date("o_orderdate").cast("string"), dep]
    body = o.select(F.concat_ws(",", *[F.concat(F.lit('"'), v, F.lit('"')) for v in vals]).alias("value"))
    header = spark.range(1).select(F.lit(HEADER).alias("value"))
    return header.unionByName(body)


def order_files(spark, sf_dir):
    """The lines of all orders as text files in a fresh folder of the shared scratch space; one file begins with the header."""
    path = scratch_folder(spark, "order-lines")
    order_lines(spark, sf_dir).write.text(path)
    return path


def parsed_orders(spark, sf_dir):
    return ingest_delimited(read_lines(spark, order_files(spark, sf_dir)), FIELDS, header_marker="o_orderkey")


_DEP = ("CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 25 = 24 THEN '2400' "
        "ELSE lpad(CAST((o_orderkey % 24) * 100 + o_orderkey % 60 AS VARCHAR), 4, '0') END")
_SRC = f"""WITH s AS (
  SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
         (CAST(o_orderdate AS DATE) - DATE '1970-01-01') * 86400000 AS day_ms,
         {_DEP} AS dep_time
  FROM orders),
p AS (
  SELECT *, CASE WHEN dep_time = '' THEN NULL WHEN dep_time = '2400' THEN day_ms
                 ELSE day_ms + CAST(substr(dep_time, 1, 2) AS BIGINT) * 3600000
                             + CAST(substr(dep_time, 3, 2) AS BIGINT) * 60000 END AS dep_ms,
         o_orderstatus || CAST(o_custkey AS VARCHAR) || ':' || o_orderdate || ':' ||
         coalesce(nullif(dep_time, ''), 'XXXX') AS flight_key
  FROM s)
"""


@query(
    "ingest_delimited",
    _SRC + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, dep_ms, flight_key FROM p",
    ("SRC-11", "PRJ-4", "FLT-19", "FN-6"),
)
def ingest_delimited_q(spark, sf_dir):
    p = parsed_orders(spark, sf_dir)
    return p.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        P.parse_time_ms("o_orderdate", "dep_time").alias("dep_ms"),
        P.compose_key("o_orderstatus", F.col("o_custkey").cast("string"), "o_orderdate", "dep_time").alias("flight_key"),
    )


@query("parse_numbers", _SRC + "SELECT o_orderkey, o_custkey, o_totalprice FROM p", ("FN-7",))
def parse_numbers_q(spark, sf_dir):
    return parsed_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")


@query("parse_times", _SRC + "SELECT o_orderkey, dep_time, dep_ms FROM p", ("FN-8",))
def parse_times_q(spark, sf_dir):
    p = parsed_orders(spark, sf_dir)
    return p.select("o_orderkey", "dep_time", P.parse_time_ms("o_orderdate", "dep_time").alias("dep_ms"))


@query("compose_key", _SRC + "SELECT o_orderkey, flight_key FROM p", ("FN-9",))
def compose_key_q(spark, sf_dir):
    p = parsed_orders(spark, sf_dir)
    return p.select(
        "o_orderkey",
        P.compose_key("o_orderstatus", F.col("o_custkey").cast("string"), "o_orderdate", "dep_time").alias("flight_key"),
    )
