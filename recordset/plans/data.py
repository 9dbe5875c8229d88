"""How the driver's tables stand in for the reference's inputs.

Every derived input is a projection/filter of a given table, so its size
grows with the table. Each Spark derivation has a DuckDB twin (``*_SQL``)
used by the oracle queries; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordset.functions.timefn import epoch_millis
from recordset.operators.report import ReportInputs

# Fixed parameters of the derived data set.
APP_EPOCH_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
HOUR_MS = 3_600_000
TD_BEFORE = "1996-01-01"
REPORT_AS_OF = "2024-01-31"  # report covers 2024-01-24 .. 2024-01-30
AS_OF_SEC = 500_000_000  # "now" for TTL / expiry, seconds
MISS_OFFSET = 1_000_000  # key shift that makes lookups miss


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def oid(c) -> F.Column:
    return F.struct(F.col(c).cast("string").alias("oid")) if isinstance(c, str) else F.struct(c.cast("string").alias("oid"))


def app_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        oid("c_custkey").alias("_id"),
        F.col("c_name").alias("name"),
        (F.lit(APP_EPOCH_MS) + (F.col("c_custkey") % 30) * F.lit(86_400_000) + F.lit(HOUR_MS)).alias("ct"),
    )


def td_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; those from TD_BEFORE on name an app that does not exist, so that some apps are unassigned."""
    early = F.col("o_orderdate") < F.lit(TD_BEFORE).cast("timestamp_ntz")
    app = F.col("o_custkey") + F.when(early, F.lit(0)).otherwise(F.lit(MISS_OFFSET))
    return table(spark, sf_dir, "orders").select(
        oid("o_orderkey").alias("_id"),
        oid(app).alias("app"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "app")
        .when(F.col("o_orderpriority") == "2-HIGH", "game")
        .otherwise("other")
        .alias("source"),
    )


def _events_of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.where(F.col("event_type") == kind).select(
        oid("event_id").alias("_id"), oid("user_id").alias("app"), epoch_millis("ts").alias("ct")
    )


def push_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(spark, sf_dir, "view")


def activity_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_of(spark, sf_dir, "click")


def dv_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase"))
    ms = epoch_millis("ts")
    return e.select(
        F.col("event_id").cast("string").alias("__key"),
        F.col("user_id").cast("string").alias("app"),
        F.when(F.col("event_type") == "signup", ms).alias("ct"),
        F.when(F.col("event_type") == "purchase", ms).alias("mt"),
        F.when(F.col("event_id") % 2 == 0, "a").otherwise("i").alias("tp"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("t"), F.col("event_id").cast("string"))).alias("token"),
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with their time in milliseconds."""
    return table(spark, sf_dir, "events").select(oid("event_id").alias("_id"), epoch_millis("ts").alias("ct"))


def report_inputs(spark: SparkSession, sf_dir: str) -> ReportInputs:
    """The five report collections."""
    return ReportInputs(
        app=app_collection(spark, sf_dir),
        td=td_collection(spark, sf_dir),
        push=push_collection(spark, sf_dir),
        activity=activity_collection(spark, sf_dir),
        dv=dv_set(spark, sf_dir),
    )


# DuckDB twins of the derivations above, as a WITH-clause prefix.
REPORT_CTES = f"""
event_t AS (SELECT {{'oid': CAST(event_id AS VARCHAR)}} AS _id, epoch_us(ts) // 1000 AS ct FROM events),
app_c AS (
  SELECT {{'oid': CAST(c_custkey AS VARCHAR)}} AS _id, c_name AS name,
         {APP_EPOCH_MS} + (c_custkey % 30) * 86400000 + {HOUR_MS} AS ct
  FROM customer),
td_c AS (
  SELECT {{'oid': CAST(o_orderkey AS VARCHAR)}} AS _id,
         {{'oid': CAST(o_custkey + CASE WHEN o_orderdate < TIMESTAMP '{TD_BEFORE} 00:00:00' THEN 0 ELSE {MISS_OFFSET} END AS VARCHAR)}} AS app,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'app'
              WHEN o_orderpriority = '2-HIGH' THEN 'game' ELSE 'other' END AS source
  FROM orders),
push_c AS (
  SELECT {{'oid': CAST(event_id AS VARCHAR)}} AS _id, {{'oid': CAST(user_id AS VARCHAR)}} AS app,
         epoch_us(ts) // 1000 AS ct
  FROM events WHERE event_type = 'view'),
activity_c AS (
  SELECT {{'oid': CAST(event_id AS VARCHAR)}} AS _id, {{'oid': CAST(user_id AS VARCHAR)}} AS app,
         epoch_us(ts) // 1000 AS ct
  FROM events WHERE event_type = 'click'),
dv_s AS (
  SELECT CAST(event_id AS VARCHAR) AS __key, CAST(user_id AS VARCHAR) AS app,
         CASE WHEN event_type = 'signup' THEN epoch_us(ts) // 1000 END AS ct,
         CASE WHEN event_type = 'purchase' THEN epoch_us(ts) // 1000 END AS mt,
         CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'i' END AS tp,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE 't' || CAST(event_id AS VARCHAR) END AS token
  FROM events WHERE event_type IN ('signup', 'purchase'))
"""
