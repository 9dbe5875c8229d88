"""Compare every catalogued query with its DuckDB oracle, as the driver does.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Checks row count, column names (sorted) and an order-insensitive hash of values.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{norm(k)}:{norm(x)}" for k, x in sorted(v.items(), key=lambda kv: str(kv[0]))) + "}"
    return str(v)


def table_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from recordset.session import local_session
    import __spark_entry__ as E

    import os

    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # A session with Spark's defaults only, like a driver that configures nothing.
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", os.environ.get("ORACLE_TZ", "Asia/Kolkata"))
                 .config("spark.sql.ansi.enabled", os.environ.get("ORACLE_ANSI", "true")).getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sql[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        ok_h = ok_cols and table_hash(scols, srows) == table_hash(dcols, drows)
        status = "OK  " if (ok_cols and ok_n and ok_h) else "FAIL"
        if status == "FAIL":
            bad += 1
        print(f"{status} {name}: rows {len(srows)}/{len(drows)} cols {ok_cols} hash {ok_h} {ts:.1f}s")
        if status == "FAIL" and ok_cols:
            order_s = sorted(range(len(scols)), key=lambda i: scols[i])
            order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
            s_set = sorted("|".join(norm(r[i]) for i in order_s) for r in srows)
            d_set = sorted("|".join(norm(r[i]) for i in order_d) for r in drows)
            print("   spark only:", [x for x in s_set if x not in set(d_set)][:3])
            print("   duck  only:", [x for x in d_set if x not in set(s_set)][:3])
        elif not ok_cols:
            print("   cols", sorted(scols), sorted(dcols))
    print(f"done, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
