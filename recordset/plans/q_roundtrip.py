"""Write-and-read-back queries (SNK-1, 2, 3, 10, 13, 16; SRC-2, 4, 12): stored sets in a fresh folder of the shared scratch space.

Each query saves whole tables through the writer and returns what a scan of the written set gives.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from recordset.operators.bucketed_write import compact, write_bucketed
from recordset.operators.keyed_write import WriteConflict, WriteSpec
from recordset.operators.lookup import intersect_match, lookup_wide
from recordset.plans.data import AS_OF_SEC, table
from recordset.plans.q_types import order_records
from recordset.plans.registry import query
from recordset.session import scratch_folder
from recordset.sources.api import reader, writer
from recordset.sources.layout import latest_version
from recordset.sources.skipping import index_bins, where
from recordset.sources.store import digest_hex


def _orders(spark, sf_dir):
    """Orders with a list bin and a map bin."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.array("o_custkey", F.col("o_orderkey")).alias("pair"), F.create_map(F.lit("cust"), F.col("o_custkey")).alias("refs"))


def _later(spark, sf_dir):
    """The second write: orders of odd keys with a new status and a bin the set did not have."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(k % 2 == 1, k).otherwise(k + 10_000_000).alias("o_orderkey"), F.lit("Z").alias("o_orderstatus"), F.col("o_totalprice").alias("price"))


def _save(df, root, name, mode, **options):
    w = writer(df).mode(mode).set(name).key("o_orderkey").option("namespace", root)
    return w.options(**options).save(as_of=AS_OF_SEC)


_TWO_WRITES_SQL = f"""
WITH a AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders),
b AS (SELECT CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey ELSE o_orderkey + 10000000 END AS k, o_totalprice FROM orders),
j AS (SELECT coalesce(a.o_orderkey, b.k) AS k, a.o_orderkey AS old, b.k AS new, a.o_orderstatus, a.o_custkey, b.o_totalprice
      FROM a FULL JOIN b ON a.o_orderkey = b.k)
SELECT CAST(k AS VARCHAR) AS __key, lower(sha1('{{name}}:L:' || CAST(k AS VARCHAR))) AS __digest, CAST(0 AS INTEGER) AS __expiry,
  CAST(CASE WHEN old IS NOT NULL AND new IS NOT NULL THEN 2 ELSE 1 END AS INTEGER) AS __generation, k AS o_orderkey,
  CASE WHEN new IS NOT NULL THEN 'Z' ELSE o_orderstatus END AS o_orderstatus, old AS pair_2, o_custkey AS cust, o_totalprice AS price FROM j
"""


def _show(df):
    return df.select("__key", digest_hex("__digest").alias("__digest"), "__expiry", "__generation", "o_orderkey", "o_orderstatus",
                     F.get("pair", F.lit(1)).alias("pair_2"), F.col("refs")["cust"].alias("cust"), "price")


@query("write_roundtrip", _TWO_WRITES_SQL.format(name="whole"), ("SNK-1", "SNK-2", "SRC-12"))
def write_roundtrip_q(spark, sf_dir):
    """Two upserts, the second with a new bin; the number of buckets is the set's own choice."""
    root = scratch_folder(spark, "set")
    _save(_orders(spark, sf_dir), root, "whole", "append")
    _save(_later(spark, sf_dir), root, "whole", "append")
    return _show(reader(spark).option("namespace", root).load("whole", as_of=AS_OF_SEC))


@query("write_roundtrip_bucketed", _TWO_WRITES_SQL.format(name="many"), ("SNK-1", "SNK-2"))
def write_roundtrip_bucketed_q(spark, sf_dir):
    root = scratch_folder(spark, "set")
    _save(_orders(spark, sf_dir), root, "many", "append", buckets=16)
    _save(_later(spark, sf_dir), root, "many", "append")
    return _show(reader(spark).option("namespace", root).load("many", as_of=AS_OF_SEC))


@query(
    "write_default_mode",
    """SELECT CAST(k AS VARCHAR) AS __key, CAST(1 AS INTEGER) AS __generation, status AS o_orderstatus FROM (
         SELECT o_orderkey AS k, o_orderstatus AS status FROM orders
         UNION ALL SELECT o_orderkey + 10000000, 'Z' FROM orders WHERE o_orderkey % 2 = 0)""",
    ("SNK-16", "SNK-10"),
)
def write_default_mode_q(spark, sf_dir):
    """Without a mode the records that exist stay as they are."""
    root = scratch_folder(spark, "set")
    _save(_orders(spark, sf_dir), root, "kept", "append")

    writer(_later(spark, sf_dir)).set("kept").key("o_orderkey").option("namespace", root).save(as_of=AS_OF_SEC)
    return reader(spark).option("namespace", root).load("kept", as_of=AS_OF_SEC).select("__key", "__generation", "o_orderstatus")


@query("write_create_fails", "SELECT CAST(o_orderkey AS VARCHAR) AS __key, o_orderstatus, true AS refused FROM orders", ("SNK-3",))
def write_create_fails_q(spark, sf_dir):
    """A create-only write that meets an existing key changes nothing, though most of its keys are new."""
    root = scratch_folder(spark, "set")
    _save(_orders(spark, sf_dir), root, "once", "errorifexists")
    try:
        _save(_later(spark, sf_dir), root, "once", "errorifexists")
        refused = False
    except WriteConflict:
        refused = True
    got = reader(spark).option("namespace", root).load("once", as_of=AS_OF_SEC)
    return got.select("__key", "o_orderstatus", F.lit(refused).alias("refused"))


@query(
    "write_renamed_metadata",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(2 AS INTEGER) AS gen, o_orderstatus, 'gen,hash,id,left,o_orderkey,o_orderstatus,pair,refs,until' AS columns FROM orders",
    ("SNK-13", "SRC-4"),
)
def write_renamed_metadata_q(spark, sf_dir):
    """A scan with renamed metadata columns, written back, gains no bins."""
    root = scratch_folder(spark, "set")
    names = {"keyColumn": "id", "digestColumn": "hash", "expiryColumn": "until", "generationColumn": "gen", "ttlColumn": "left"}
    _save(_orders(spark, sf_dir), root, "named", "append")
    seen = reader(spark).options(namespace=root, **names).load("named", as_of=AS_OF_SEC)
    _save(seen, root, "named", "append", **names)
    got = reader(spark).options(namespace=root, **names).load("named", as_of=AS_OF_SEC)
    return got.select("id", "gen", "o_orderstatus", F.lit(",".join(sorted(got.columns))).alias("columns"))


def _price(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


@query(
    "write_roundtrip_growing",
    """SELECT CAST(o_orderkey AS VARCHAR) AS __key, CAST(1 + (o_orderkey % 50 = 0)::INT + (o_orderkey % 7 = 0)::INT AS INTEGER) AS __generation, o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice, true AS grown, true AS split FROM orders""",
    ("SNK-1", "SNK-6"),
)
def write_roundtrip_growing_q(spark, sf_dir):
    """A small first write, then all orders, then an upsert of every seventh: buckets split by size, records in deltas count once."""
    root = scratch_folder(spark, "set")
    spec = WriteSpec("grow", mode="append", key_col="o_orderkey", as_of=AS_OF_SEC)
    orders = _price(spark, sf_dir)
    estimate = int(str(orders._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size = max(estimate // 4, 32 << 10)  # a set that ends with a few dozen buckets at any larger scale
    k = F.col("o_orderkey")
    write_bucketed(spark, orders.where(k % 50 == 0), f"{root}/grow", spec, buckets=1, bucket_bytes=size)
    write_bucketed(spark, orders, f"{root}/grow", spec, bucket_bytes=size)
    write_bucketed(spark, orders.where(k % 7 == 0).withColumn("o_totalprice", F.lit(-1.0)), f"{root}/grow", spec, bucket_bytes=size)
    _, now = latest_version(spark, f"{root}/grow")
    largest = max(sum(s.bytes for s in own) for own in now.segments.values())
    got = reader(spark).option("namespace", root).load("grow", as_of=AS_OF_SEC)
    return got.select("__key", "__generation", "o_orderkey", "o_totalprice", F.lit(now.buckets > 1).alias("grown"), F.lit(largest <= 2 * size).alias("split"))


@query(
    "write_back_scanned",
    """SELECT CAST(o_orderkey AS VARCHAR) AS __key, lower(sha1('back:L:' || CAST(o_orderkey AS VARCHAR))) AS __digest, CAST(2 AS INTEGER) AS __generation,
         o_orderkey, o_totalprice + 1 AS o_totalprice, '__digest,__expiry,__generation,__key,__ttl,o_orderkey,o_totalprice' AS columns FROM orders""",
    ("SNK-8", "SNK-13", "SRC-3"),
)
def write_back_scanned_q(spark, sf_dir):
    """Scan, change, write back by the key column that the scan itself gives: the same records, no new bin."""
    root = scratch_folder(spark, "set")
    _save(_price(spark, sf_dir), root, "back", "append")
    seen = reader(spark).option("namespace", root).load("back", as_of=AS_OF_SEC).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    writer(seen).mode("append").set("back").key("__key").option("namespace", root).save(as_of=AS_OF_SEC)
    got = reader(spark).option("namespace", root).load("back", as_of=AS_OF_SEC)
    return got.select("__key", digest_hex("__digest").alias("__digest"), "__generation", "o_orderkey", "o_totalprice", F.lit(",".join(sorted(got.columns))).alias("columns"))


@query(
    "write_key_or_digest",
    "SELECT CAST(o_orderkey AS VARCHAR) AS __key, o_totalprice, 'both refused, neither refused' AS checks FROM orders",
    ("SNK-10",),
)
def write_key_or_digest_q(spark, sf_dir):
    """A write that names both a key and a digest column, or neither, is refused and changes nothing."""
    root = scratch_folder(spark, "set")
    _save(_price(spark, sf_dir), root, "one", "append")
    changed = _price(spark, sf_dir).withColumn("o_totalprice", F.lit(0.0)).withColumn("d", F.unhex(F.sha1(F.col("o_orderkey").cast("string"))))
    checks = []
    for name, w in (("both", writer(changed).key("o_orderkey").digest("d")), ("neither", writer(changed))):
        try:
            w.mode("append").set("one").option("namespace", root).save(as_of=AS_OF_SEC)
            checks.append(f"{name} written")
        except ValueError:
            checks.append(f"{name} refused")
    got = reader(spark).option("namespace", root).load("one", as_of=AS_OF_SEC)
    return got.select("__key", "o_totalprice", F.lit(", ".join(checks)).alias("checks"))


@query(
    "compact_expired",
    """SELECT CAST(o_orderkey AS VARCHAR) AS __key, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice,
         (SELECT count(*) FROM orders WHERE o_orderkey % 5 <> 0) AS stored FROM orders WHERE o_orderkey % 5 <> 0""",
    ("SNK-12", "SRC-5"),
)
def compact_expired_q(spark, sf_dir):
    """Every fifth order expires after a second; a later compaction leaves as many stored records as live ones, deltas folded."""
    root = scratch_folder(spark, "set")
    rows = _price(spark, sf_dir).withColumn("ttl", F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(-1))
    _save(rows, root, "dies", "append", buckets=8, ttlColumn="ttl")
    _save(_price(spark, sf_dir).where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0)), root, "dies", "append")
    now = compact(spark, f"{root}/dies", AS_OF_SEC + 10)
    got = reader(spark).option("namespace", root).load("dies", as_of=AS_OF_SEC)
    return got.select("__key", "o_orderkey", "o_totalprice", F.lit(now.rows).cast("long").alias("stored"))


@query(
    "lookup_mixed_key_types",
    """SELECT 'found' AS part, o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'integer' ELSE 'text' END AS kind, count(*) AS n FROM orders GROUP BY ALL
       UNION ALL SELECT 'matched', o_orderkey, NULL, 1 FROM orders WHERE o_orderkey % 2 = 0""",
    ("JN-1", "JN-3", "JN-4"),
)
def lookup_mixed_key_types_q(spark, sf_dir):
    """A set with every order under its integer key and under the same key as text: a lookup finds the record of its own type, a match keeps each row once."""
    root = scratch_folder(spark, "set")
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    text = keys.select(F.col("k").cast("string").alias("k"))
    for name, df, kind in (("number", keys, "integer"), ("word", text, "text")):
        own = df.select(F.col("k").alias(name), F.lit(kind).alias("kind"))
        writer(own).mode("append").set("mixed").key(name).option("namespace", root).save(as_of=AS_OF_SEC)
    view = reader(spark).option("namespace", root).load("mixed", as_of=AS_OF_SEC)
    even = keys.where("k % 2 = 0")
    odd = text.where("CAST(k AS BIGINT) % 2 = 1")
    found = lookup_wide(even, "k", view, ["kind"]).unionByName(lookup_wide(odd, "k", view, ["kind"]))
    # A key found is a group of its own. Dealt to a fixed number of tasks: by their few bytes they would be gathered into one, whose table holds them all.
    found = found.select(F.col("key").cast("long").alias("k"), "kind").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k", "kind")
    found = found.groupBy("k", "kind").agg(F.count(F.lit(1)).alias("n")).select(F.lit("found").alias("part"), "k", "kind", "n")
    probe = even.withColumn("kind", F.lit("integer"))
    matched = intersect_match(probe, "k", view.drop("number", "word"), keep_unmatched=False).select(
        F.lit("matched").alias("part"), "k", F.lit(None).cast("string").alias("kind"), F.lit(1).cast("long").alias("n"))
    return found.unionByName(matched)


def _files(df):
    """How many segments the plan opens files of; a large one has several."""
    return len({f.rsplit("/", 1)[0] for f in df.inputFiles()})


@query(
    "keyed_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS __key, o_orderkey, o_totalprice, true AS few_files FROM orders
       WHERE o_orderkey IN ((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) FROM orders))""",
    ("SRC-1", "SRC-9", "FLT-1"),
)
def keyed_scan_q(spark, sf_dir):
    """Two keys of a set of 64 buckets: at most two buckets are opened."""
    root = scratch_folder(spark, "set")
    _save(_price(spark, sf_dir), root, "keyed", "append", buckets=64)
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    got = reader(spark).option("namespace", root).load("keyed", as_of=AS_OF_SEC, where=where("__key", "in", list(ends)))
    return got.select("__key", "o_orderkey", "o_totalprice", F.lit(_files(got) <= 2).alias("few_files"))


@query(
    "contains_indexed",
    """WITH one AS (SELECT o_custkey AS c FROM orders GROUP BY o_custkey ORDER BY count(*), o_custkey LIMIT 1),
       stored AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS cust, 'c' || o_custkey AS name FROM orders)
       SELECT 'list' AS bin, o_orderkey, true AS few_files FROM stored WHERE cust = (SELECT c FROM one)
       UNION ALL SELECT 'list, replaced', o_orderkey, true FROM stored WHERE cust = -(SELECT c FROM one)
       UNION ALL SELECT 'map', o_orderkey, true FROM stored WHERE name = 'c' || (SELECT c FROM one)""",
    ("FLT-2", "FLT-3", "SRC-9"),
)
def contains_indexed_q(spark, sf_dir):
    """Items of a list bin and keys of a map bin by their index, before and after every fifth order is replaced: only buckets that hold the item are opened."""
    root = scratch_folder(spark, "set")
    orders = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = orders.select(k, F.array(c, k + 10**12).alias("items"), F.create_map(F.concat(F.lit("c"), c.cast("string")), k).alias("names"))
    _save(rows, root, "items", "append", buckets=64, indexBins="items")
    index_bins(spark, f"{root}/items", ["names"])
    _save(rows.where(k % 5 == 0).withColumn("items", F.transform("items", lambda x: -x)), root, "items", "append")
    cust, n = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "o_custkey").first()
    parts = []
    for label, f in (("list", where("items", "=", cust)), ("list, replaced", where("items", "=", -cust)), ("map", where("names", "=", f"c{cust}"))):
        got = reader(spark).option("namespace", root).load("items", as_of=AS_OF_SEC, where=f)
        parts.append(got.select(F.lit(label).alias("bin"), "o_orderkey", F.lit(_files(got) <= 2 * n).alias("few_files")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "range_skipping",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS year, true AS bases_closed FROM orders
       WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) FROM orders) AND o_totalprice > 1000""",
    ("SRC-9", "FLT-4", "FLT-5", "FLT-12"),
)
def range_skipping_q(spark, sf_dir):
    """Orders of the last year arrive after the others; a range over the year and one over the price open the deltas and no base."""
    root = scratch_folder(spark, "set")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("year"))
    last = rows.agg(F.max("year")).first()[0]
    _save(rows.where(F.col("year") < last), root, "years", "append", buckets=8, indexBins="year,o_totalprice")
    _, before = latest_version(spark, f"{root}/years")
    old = {s.write for own in before.segments.values() for s in own}
    _save(rows.where(F.col("year") == last), root, "years", "append")
    got = reader(spark).option("namespace", root).load("years", as_of=AS_OF_SEC, where=where("year", ">=", last) & where("o_totalprice", ">", 1000.0))
    closed = not any(f"/w={w}/" in f for f in got.inputFiles() for w in old)
    return got.select("o_orderkey", "o_totalprice", "year", F.lit(closed).alias("bases_closed"))


@query(
    "typed_bins_kept",
    """SELECT o_orderkey, o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN 'e' END AS extra,
         CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS price FROM orders""",
    ("SRC-6", "SRC-7"),
)
def typed_bins_kept_q(spark, sf_dir):
    """Orders as JSON records whose types are kept at the write; every fiftieth is then replaced by a record of other bins."""
    root = scratch_folder(spark, "set")
    records = order_records(spark, sf_dir)
    _save(records, root, "json", "append", buckets=8, jsonBins="j")
    other = records.where("o_orderkey % 50 = 0").select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.lit("e").alias("extra"))).alias("j"))
    _save(other, root, "json", "append")
    return reader(spark).option("namespace", root).load("json", as_of=AS_OF_SEC, json_bins="j").select("o_orderkey", "k", "extra", "price")
