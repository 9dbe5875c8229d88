"""Keyed-write queries (SNK-3..15, SNK-17) on a customer set.

target   = all customers, odd keys shifted by TARGET_SHIFT, generation 1 + key % 3, expiry as in
           ``synthetic_customer_set`` (keys with key % 7 < 2 have expired);
incoming = all customers, keys not divisible by 3 shifted by INCOMING_SHIFT, carrying a changed segment (null when
           key % 5 = 0) and an expected generation equal to the stored one
           when key % 4 = 0, else one more.
Each query returns the whole set after the write (or the per-key outcomes).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordset.operators import keyed_write as W
from recordset.plans.data import table, AS_OF_SEC
from recordset.plans.q_scan import synthetic_customer_set
from recordset.plans.registry import query
from recordset.sources.store import digest, digest_hex

SET = "customer"
BINS = ["c_acctbal", "c_custkey", "c_mktsegment", "c_name", "c_nationkey"]


# Shifted keys stand for records that only one side has. The rules above apply to the shifted keys.
TARGET_SHIFT, INCOMING_SHIFT = 1_000_000, 3_000_001


def _shifted(spark, sf_dir, stays, shift):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").withColumn("c_custkey", F.when(stays(k), k).otherwise(k + shift))


def target_set(spark, sf_dir):
    return synthetic_customer_set(spark, sf_dir, _shifted(spark, sf_dir, lambda k: k % 2 == 0, TARGET_SHIFT))


def incoming_rows(spark, sf_dir, with_ttl=False, null_bin=False):
    c = _shifted(spark, sf_dir, lambda k: k % 3 == 0, INCOMING_SHIFT)
    k = F.col("c_custkey")
    stored_gen = 1 + k % 3
    cols = [
        "c_custkey",
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat("c_mktsegment", F.lit("*"))).alias("c_mktsegment"),
        F.when(k % 4 == 0, stored_gen).otherwise(stored_gen + 1).alias("__generation"),
    ]
    if null_bin:
        cols = ["c_custkey", F.lit(None).cast("double").alias("c_acctbal"), cols[2]]
    if with_ttl:
        cols.append(F.when(k % 4 == 0, F.lit(-1)).otherwise((k % 4) * 100).alias("__ttl"))
    return c.select(*cols)


def _show(df: DataFrame) -> DataFrame:
    return df.select("__key", digest_hex("__digest").alias("__digest"), "__expiry", "__generation", *BINS)


def _write(spark, sf_dir, mode, **kw):
    inc_kw = {k: kw.pop(k) for k in ("with_ttl", "null_bin") if k in kw}
    spec = W.WriteSpec(SET, mode=mode, key_col="c_custkey", as_of=AS_OF_SEC, **kw)
    return _show(W.merge(target_set(spark, sf_dir), incoming_rows(spark, sf_dir, **inc_kw), spec))


# ---- DuckDB oracle ------------------------------------------------------------

_EXP = f"CASE WHEN c_custkey % 7 = 2 THEN 0 ELSE {AS_OF_SEC} + (c_custkey % 7 - 2) * 100 END"


def _write_sql(mode: str, gen_check=False, ttl=False, null_bin=False, outcomes=False, by_digest=False) -> str:
    seg = "NULL::DOUBLE AS i_acctbal" if null_bin else \
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment || '*' END AS i_seg"
    ttl_sql = ", CASE WHEN c_custkey % 4 = 0 THEN -1 ELSE (c_custkey % 4) * 100 END AS i_ttl" if ttl else ""
    exists_o = {"errorifexists": "exists_error", "ignore": "skipped_exists", "overwrite": "replaced",
                "append": "updated", "update_only": "updated"}[mode]
    absent_o = "skipped_missing" if mode == "update_only" else "created"
    gen_sql = "WHEN NOT coalesce(i_gen = CASE WHEN live THEN t_gen ELSE 0 END, false) THEN 'generation_conflict' " if gen_check else ""
    new_exp = (f"CASE WHEN i_ttl = -1 THEN 0 WHEN i_ttl IS NULL OR i_ttl = 0 THEN NULL ELSE {AS_OF_SEC} + i_ttl END"
               if ttl else "NULL")
    head = f"""
WITH t AS (
  SELECT CAST(c_custkey AS VARCHAR) AS t_key, lower(sha1('{SET}:L:' || CAST(c_custkey AS VARCHAR))) AS t_digest,
         CAST({_EXP} AS INTEGER) AS t_exp, CAST(1 + c_custkey % 3 AS INTEGER) AS t_gen,
         c_acctbal AS t_acctbal, c_custkey AS t_custkey, c_mktsegment AS t_seg, c_name AS t_name, c_nationkey AS t_nation
  FROM (SELECT * REPLACE (c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE {TARGET_SHIFT} END AS c_custkey) FROM customer)),
i AS (
  SELECT {"NULL::VARCHAR" if by_digest else "CAST(c_custkey AS VARCHAR)"} AS i_key, lower(sha1('{SET}:L:' || CAST(c_custkey AS VARCHAR))) AS i_digest,
         c_custkey AS i_custkey, {seg},
         CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 + c_custkey % 3 ELSE 2 + c_custkey % 3 END AS INTEGER) AS i_gen {ttl_sql}
  FROM (SELECT * REPLACE (c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE {INCOMING_SHIFT} END AS c_custkey) FROM customer)),
j0 AS (
  SELECT *, t_key IS NOT NULL AND (t_exp = 0 OR t_exp > {AS_OF_SEC}) AS live, i_digest IS NOT NULL AS inc
  FROM t FULL OUTER JOIN i ON t_digest = i_digest),
j AS (
  SELECT *, CASE WHEN NOT inc THEN 'untouched' {gen_sql}WHEN live THEN '{exists_o}' ELSE '{absent_o}' END AS o,
         {new_exp} AS new_exp
  FROM j0)
"""
    if outcomes:
        return head + "SELECT i_key AS __key, o AS outcome FROM j WHERE inc"
    keep = "o IN ('untouched', 'skipped_exists', 'skipped_missing', 'generation_conflict')"
    if null_bin:
        seg_v = f"CASE WHEN {keep} OR o = 'updated' THEN t_seg END"
        acct_v = f"CASE WHEN {keep} THEN t_acctbal ELSE i_acctbal END"
    else:
        seg_v = f"CASE WHEN {keep} THEN t_seg ELSE i_seg END"
        acct_v = f"CASE WHEN {keep} OR o = 'updated' THEN t_acctbal END"
    name_v = f"CASE WHEN {keep} OR o = 'updated' THEN t_name END"
    cust_v = (f"CASE WHEN {keep} OR o = 'updated' THEN t_custkey END" if by_digest
              else f"CASE WHEN {keep} THEN t_custkey ELSE i_custkey END")
    nat_v = f"CASE WHEN {keep} OR o = 'updated' THEN t_nation END"
    return head + f"""
SELECT CASE WHEN {keep} THEN t_key ELSE coalesce(i_key, t_key) END AS __key,
       CASE WHEN {keep} THEN t_digest ELSE i_digest END AS __digest,
       CAST(CASE WHEN {keep} THEN t_exp WHEN o = 'created' THEN coalesce(new_exp, 0)
                 ELSE coalesce(new_exp, t_exp) END AS INTEGER) AS __expiry,
       CAST(CASE WHEN {keep} THEN t_gen WHEN o = 'created' THEN 1 ELSE t_gen + 1 END AS INTEGER) AS __generation,
       {acct_v} AS c_acctbal,
       {cust_v} AS c_custkey,
       {seg_v} AS c_mktsegment, {name_v} AS c_name, {nat_v} AS c_nationkey
FROM j WHERE NOT ({keep}) OR t_key IS NOT NULL"""


@query("write_ignore", _write_sql("ignore"), ("SNK-4", "SNK-8"))
def write_ignore_q(spark, sf_dir):
    return _write(spark, sf_dir, "ignore")


@query("write_replace", _write_sql("overwrite"), ("SNK-5",))
def write_replace_q(spark, sf_dir):
    return _write(spark, sf_dir, "overwrite")


@query("write_upsert", _write_sql("append"), ("SNK-6",))
def write_upsert_q(spark, sf_dir):
    return _write(spark, sf_dir, "append")


@query("write_upsert_nulls", _write_sql("append", null_bin=True), ("SNK-15",))
def write_upsert_nulls_q(spark, sf_dir):
    return _write(spark, sf_dir, "append", null_bin=True)


@query("write_update_only", _write_sql("update_only"), ("SNK-7",))
def write_update_only_q(spark, sf_dir):
    return _write(spark, sf_dir, "update_only")


@query("write_generation_check", _write_sql("append", gen_check=True), ("SNK-11",))
def write_generation_check_q(spark, sf_dir):
    return _write(spark, sf_dir, "append", generation_policy="expect_gen_equal")


@query("write_ttl", _write_sql("append", ttl=True), ("SNK-12",))
def write_ttl_q(spark, sf_dir):
    return _write(spark, sf_dir, "append", with_ttl=True, ttl_col="__ttl")


@query(
    "write_create_conflicts",
    _write_sql("errorifexists", outcomes=True).replace(
        "SELECT i_key AS __key, o AS outcome FROM j WHERE inc",
        "SELECT i_key AS __key, o AS outcome FROM j WHERE inc AND o = 'exists_error'"),
    ("SNK-3",),
)
def write_create_conflicts_q(spark, sf_dir):
    spec = W.WriteSpec(SET, mode="errorifexists", key_col="c_custkey", as_of=AS_OF_SEC)
    return W.conflicts(target_set(spark, sf_dir), incoming_rows(spark, sf_dir), spec).select("__key", "outcome")


_OUTCOME_CASES = [("ignore", False), ("overwrite", False), ("append", False), ("update_only", False), ("append", True)]


def _outcomes_sql() -> str:
    parts = []
    for mode, gen in _OUTCOME_CASES:
        label = mode + ("+gen" if gen else "")
        parts.append(f"SELECT '{label}' AS mode, __key, outcome FROM ({_write_sql(mode, gen_check=gen, outcomes=True)})")
    return "\nUNION ALL\n".join(parts)


@query("write_outcomes", _outcomes_sql(), ("SNK-17",))
def write_outcomes_q(spark, sf_dir):
    # One key join serves all five modes; each mode only adds its outcome rule.
    specs = {
        mode + ("+gen" if gen else ""): W.WriteSpec(SET, mode=mode, key_col="c_custkey", as_of=AS_OF_SEC,
                                                   generation_policy="expect_gen_equal" if gen else "none")
        for mode, gen in _OUTCOME_CASES
    }
    o = W.classify_many(target_set(spark, sf_dir), incoming_rows(spark, sf_dir), specs)
    return o.select(F.col("label").alias("mode"), "__key", "outcome")


@query("write_by_digest", _write_sql("append", by_digest=True), ("SNK-9",))
def write_by_digest_q(spark, sf_dir):
    inc = incoming_rows(spark, sf_dir)
    kt = inc.schema["c_custkey"].dataType
    by_digest = inc.select(digest(SET, "c_custkey", kt).alias("row_digest"), "c_mktsegment", "__generation")
    spec = W.WriteSpec(SET, mode="append", digest_col="row_digest", as_of=AS_OF_SEC)
    return _show(W.merge(target_set(spark, sf_dir), by_digest, spec))


@query(
    "bins_only",
    "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer",
    ("SNK-13",),
)
def bins_only_q(spark, sf_dir):
    from recordset.sources.store import bins_only
    from recordset.plans.q_scan import customer_set

    return bins_only(customer_set(spark, sf_dir))
