"""Type queries: schema inference and typed bins (SRC-6, SRC-7), storage types (SNK-14), map to record (FN-14)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.functions.types import map_to_struct, normalise_types
from recordset.plans.data import table
from recordset.plans.registry import query
from recordset.sources.schema import infer_bin_types, infer_schema, typed_bins


def order_records(spark, sf_dir):
    """Orders as JSON records: plain bins, a conflict of types, bins that many records lack, a late one, nested ones."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    record = F.struct(
        k.alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), (k % 2 == 0).alias("even"),
        F.when(k % 1000 == 7, k).alias("late"), F.array(c, k).alias("l"), F.create_map(F.lit("p"), c).alias("m"),
        F.array(F.create_map(F.lit("a"), k)).alias("lm"),
    )
    mixed = F.when(k % 7 == 0, F.concat(F.lit('"s'), k.cast("string"), F.lit('"'))).otherwise(k.cast("string"))
    body = F.regexp_replace(F.to_json(record), r"\}$", "")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(body, F.lit(',"mixed":'), mixed, F.lit("}")).alias("j"))


# The same bins, each with the type its values in the table call for.
_BIN_TYPES_SQL = """
SELECT bin, type FROM (
  SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 1000 = 7) AS n_late,
         count(*) FILTER (WHERE o_orderkey % 7 = 0) AS n_text,
         count(*) FILTER (WHERE o_totalprice <> floor(o_totalprice)) AS n_fraction FROM orders),
LATERAL (VALUES ('even', 'STRING', n > 0), ('k', 'BIGINT', n > 0), ('l', 'ARRAY<BIGINT>', n > 0),
  ('late', 'BIGINT', n_late > 0), ('lm', 'ARRAY<MAP<STRING, BIGINT>>', n > 0), ('m', 'MAP<STRING, BIGINT>', n > 0),
  ('mixed', CASE WHEN n_text > 0 THEN 'STRING' ELSE 'BIGINT' END, n > 0),
  ('price', CASE WHEN n_fraction > 0 THEN 'DOUBLE' ELSE 'BIGINT' END, n > 0), ('status', 'STRING', n > 0)) v(bin, type, met)
WHERE met
"""


@query("infer_bin_schema", _BIN_TYPES_SQL, ("SRC-6",))
def infer_bin_schema_q(spark, sf_dir):
    return infer_bin_types(order_records(spark, sf_dir), "j")


@query(
    "typed_bins",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS even, o_orderkey AS k, o_orderkey AS l2,
              CASE WHEN o_orderkey % 1000 = 7 THEN o_orderkey END AS late, o_orderkey AS lm_a, o_custkey AS m_p,
              CASE WHEN o_orderkey % 7 = 0 THEN 's' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS mixed,
              o_totalprice AS price, o_orderstatus AS status
         FROM orders""",
    ("SRC-7",),
)
def typed_bins_q(spark, sf_dir):
    records = order_records(spark, sf_dir)
    t = typed_bins(records, "j", infer_schema(records, "j"), keep=["o_orderkey"])
    return t.select("o_orderkey", "even", "k", F.element_at("l", 2).alias("l2"), "late", F.element_at(F.element_at("lm", 1), "a").alias("lm_a"),
                    F.element_at("m", "p").alias("m_p"), "mixed", "price", "status")


@query(
    "normalise_types",
    """SELECT o_orderkey,
              CAST(o_custkey AS BIGINT) AS i, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS f,
              CAST(o_orderstatus = 'F' AS VARCHAR) AS b,
              (CAST(o_orderdate AS DATE) - DATE '1970-01-01') * 86400000 AS d,
              CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) AS dec,
              CAST(o_orderdate AS VARCHAR) AS ts,
              CAST(o_custkey % 100 AS BIGINT) AS s,
              CAST(o_custkey AS BIGINT) AS first_elem
         FROM orders""",
    ("SNK-14",),
)
def normalise_types_q(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    raw = o.select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("i"),
        F.col("o_totalprice").cast("float").alias("f"),
        (F.col("o_orderstatus") == "F").alias("b"),
        F.to_date("o_orderdate").alias("d"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("dec"),
        F.col("o_orderdate").alias("ts"),
        (F.col("o_custkey") % 100).cast("short").alias("s"),
        F.array(F.col("o_custkey").cast("int")).alias("arr"),
    )
    n = normalise_types(raw)
    return n.select("o_orderkey", "i", "f", "b", "d", "dec", "ts", "s", F.element_at("arr", 1).alias("first_elem"))


CUSTOMER_CASE = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("segment", T.StringType(), True),
    T.StructField("phone", T.StringType(), True),  # optional, absent from every map
])


@query(
    "map_to_struct",
    "SELECT c_custkey, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS phone FROM customer",
    ("FN-14",),
)
def map_to_struct_q(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    m = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"),
                     F.lit("nation"), F.col("c_nationkey").cast("string"))  # extra entry, ignored
    return c.select("c_custkey", map_to_struct(m, CUSTOMER_CASE).alias("r")).select("c_custkey", "r.*")
