"""Report queries: inputs, segments, day functions, metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordset.functions.timefn import (
    date_ms,
    day_end_ms,
    day_start_ms,
    days_before_ms,
    format_datetime,
    format_day,
    in_day_exclusive,
)
from recordset.operators import report as R
from recordset.plans.data import REPORT_AS_OF, REPORT_CTES, event_times, report_inputs
from recordset.plans.registry import query
from recordset.session import scratch_folder

DAYS = 7

# ---- DuckDB building blocks -------------------------------------------------

_SEG_SQL = """
seg AS (
  SELECT a._id.oid AS oid, a.ct AS act, 'app' AS segment
    FROM app_c a JOIN td_c t ON a._id = t.app WHERE t.source = 'app'
  UNION ALL
  SELECT a._id.oid, a.ct, 'game' FROM app_c a JOIN td_c t ON a._id = t.app WHERE t.source = 'game'
  UNION ALL
  SELECT a._id.oid, a.ct, 'none' FROM app_c a
   WHERE NOT EXISTS (SELECT 1 FROM td_c t WHERE t.app = a._id))
"""

def _days_sql(as_of: str) -> str:
    return f"""
days AS (SELECT CAST(d AS INTEGER) AS days_ago, {date_ms(as_of)} - d * 86400000 AS s FROM range(1, {DAYS + 1}) r(d)),
spine AS (SELECT days_ago, s, segment FROM days, (VALUES ('app'), ('game'), ('none')) v(segment))
"""

# metric -> SQL counting (days_ago, segment, n) with the reference's join shape.
_METRIC_SQL = {
    "pushes": "SELECT d.days_ago, g.segment, count(*) AS n FROM days d JOIN push_c p "
    "ON p.ct > d.s AND p.ct < d.s + 86399999 JOIN seg g ON g.oid = p.app.oid GROUP BY 1, 2",
    "activities": "SELECT d.days_ago, g.segment, count(*) AS n FROM days d JOIN activity_c p "
    "ON p.ct > d.s AND p.ct < d.s + 86399999 JOIN seg g ON g.oid = p.app.oid GROUP BY 1, 2",
    "new_devices": "SELECT d.days_ago, g.segment, count(*) AS n FROM days d JOIN dv_s v "
    "ON v.ct > d.s AND v.ct < d.s + 86399999 JOIN seg g ON g.oid = v.app "
    "WHERE v.ct IS NOT NULL AND (v.tp = 'a' OR (v.tp = 'i' AND length(v.token) > 0)) GROUP BY 1, 2",
    "active_devices": "SELECT d.days_ago, g.segment, count(*) AS n FROM days d JOIN dv_s v "
    "ON v.mt > d.s AND v.mt < d.s + 86399999 JOIN seg g ON g.oid = v.app "
    "WHERE v.mt IS NOT NULL GROUP BY 1, 2",
    "apps_added": "SELECT d.days_ago, g.segment, count(*) AS n FROM days d JOIN seg g "
    "ON g.act > d.s AND g.act < d.s + 86399999 GROUP BY 1, 2",
}


def _report_sql(metrics: list[str], spine: bool, total: bool, as_of: str = REPORT_AS_OF) -> str:
    ctes = [REPORT_CTES.strip(), _SEG_SQL.strip(), _days_sql(as_of).strip()]
    for m in metrics:
        ctes.append(f"m_{m} AS ({_METRIC_SQL[m]})")
    if total:
        ctes.append("tot AS (SELECT segment, count(*) AS n FROM seg GROUP BY segment)")
    if spine:
        base = "spine sp"
    else:
        keys = " UNION ".join(f"SELECT days_ago, segment FROM m_{m}" for m in metrics)
        ctes.append(f"present AS ({keys})")
        base = "present sp"
    joins = " ".join(f"LEFT JOIN m_{m} ON m_{m}.days_ago = sp.days_ago AND m_{m}.segment = sp.segment" for m in metrics)
    if total:
        joins += " LEFT JOIN tot ON tot.segment = sp.segment"
    cols = ", ".join(f"CAST(coalesce(m_{m}.n, 0) AS BIGINT) AS {m}" for m in metrics)
    if total:
        cols += ", CAST(coalesce(tot.n, 0) AS BIGINT) AS apps_total"
    return (
        "WITH " + ",\n".join(ctes) + "\n"
        f"SELECT CAST(DATE '{as_of}' - sp.days_ago AS VARCHAR) AS day, sp.days_ago, sp.segment, {cols}\n"
        f"FROM {base} {joins}"
    )


def _report(spark, sf_dir, metrics, spine=True, total=False):
    return R.segment_report(report_inputs(spark, sf_dir), REPORT_AS_OF, DAYS, metrics=metrics, spine=spine, with_total=total)


# ---- inputs and segments ----------------------------------------------------


@query(
    "report_inputs",
    "WITH " + REPORT_CTES + """
    SELECT 'app' AS input, count(*) AS n FROM app_c UNION ALL
    SELECT 'td', count(*) FROM td_c UNION ALL
    SELECT 'push', count(*) FROM push_c UNION ALL
    SELECT 'activity', count(*) FROM activity_c UNION ALL
    SELECT 'dv', count(*) FROM dv_s""",
    ("SRC-10",),
)
def report_inputs_q(spark, sf_dir):
    i = report_inputs(spark, sf_dir)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("input"), "n")
        for name, df in [("app", i.app), ("td", i.td), ("push", i.push), ("activity", i.activity), ("dv", i.dv)]
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "segment_split",
    "WITH " + REPORT_CTES + """
    SELECT a._id.oid AS app_oid, a.name, t.source AS segment
      FROM app_c a JOIN td_c t ON a._id = t.app WHERE t.source IN ('app', 'game')""",
    ("JN-5", "FLT-18", "PRJ-2"),
)
def segment_split_q(spark, sf_dir):
    i = report_inputs(spark, sf_dir)
    parts = [
        R.segment_rows(i.app, i.td, s).select(F.col("_id.oid").alias("app_oid"), "name", F.col("source").alias("segment"))
        for s in ("app", "game")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "segment_unassigned",
    "WITH " + REPORT_CTES + """
    SELECT a._id.oid AS app_oid, a.name, a.ct FROM app_c a
     WHERE NOT EXISTS (SELECT 1 FROM td_c t WHERE t.app = a._id)""",
    ("JN-7", "SRC-13"),
)
def segment_unassigned_q(spark, sf_dir):
    i = report_inputs(spark, sf_dir)
    # The reference states this one as SQL text; DataFrame arguments bind the
    # inputs without shared view names (safe when queries run concurrently).
    return spark.sql(
        "SELECT a._id.oid AS app_oid, a.name, a.ct FROM {app} a "
        "WHERE NOT EXISTS (SELECT 1 FROM {td} t WHERE a._id = t.app)",
        app=i.app, td=i.td,
    )


@query(
    "nested_field_join",
    "WITH " + REPORT_CTES + "," + _SEG_SQL + """
    SELECT g.segment, g.oid AS app_oid, v.__key AS dv_key FROM seg g JOIN dv_s v ON g.oid = v.app""",
    ("JN-6", "PRJ-3"),
)
def nested_field_join_q(spark, sf_dir):
    i = report_inputs(spark, sf_dir)
    app_rows = reduce(
        DataFrame.unionByName,
        [R.segment_rows(i.app, i.td, s).select("_id", F.lit(s).alias("segment")) for s in ("app", "game")]
        + [R.unassigned_apps(i.app, i.td).select("_id", F.lit("none").alias("segment"))],
    )
    return app_rows.join(i.dv, app_rows["_id.oid"] == i.dv["app"]).select(
        "segment", F.col("_id.oid").alias("app_oid"), F.col("__key").alias("dv_key")
    )


# ---- day functions ----------------------------------------------------------


@query(
    "day_bounds",
    "WITH " + REPORT_CTES + """
    SELECT p._id.oid AS event_oid, p.ct, (p.ct // 86400000) * 86400000 AS day_start_ms,
           (p.ct // 86400000) * 86400000 + 86399999 AS day_end_ms FROM event_t p""",
    ("FN-1", "FN-2"),
)
def day_bounds_q(spark, sf_dir):
    p = event_times(spark, sf_dir)
    return p.select(
        F.col("_id.oid").alias("event_oid"), "ct", day_start_ms("ct").alias("day_start_ms"), day_end_ms("ct").alias("day_end_ms")
    )


@query(
    "day_window",
    "WITH " + REPORT_CTES + """
    SELECT CAST(CAST(make_timestamp(((ct // 86400000) * 86400000) * 1000) AS DATE) AS VARCHAR) AS day,
           count(*) AS n_all,
           count(*) FILTER (WHERE ct > (ct // 86400000) * 86400000
                              AND ct < (ct // 86400000) * 86400000 + 86399999) AS n_inside
      FROM event_t GROUP BY 1""",
    ("FLT-16",),
)
def day_window_q(spark, sf_dir):
    p = event_times(spark, sf_dir)
    start = day_start_ms("ct")
    return (
        p.select("ct", start.alias("s"))
        .groupBy("s")
        .agg(F.count(F.lit(1)).alias("n_all"), F.count_if(in_day_exclusive("ct", F.col("s"))).alias("n_inside"))
        .select(format_day("s").alias("day"), "n_all", "n_inside")
    )


@query(
    "days_before",
    "WITH " + REPORT_CTES + f"""
    SELECT p._id.oid AS event_oid, p.ct - {DAYS} * 86400000 AS before_ms,
           strftime(make_timestamp((p.ct - {DAYS} * 86400000) * 1000), '%Y-%m-%d %H:%M:%S') AS before_text
      FROM event_t p""",
    ("FN-3",),
)
def days_before_q(spark, sf_dir):
    p = event_times(spark, sf_dir)
    b = days_before_ms("ct", DAYS)
    return p.select(F.col("_id.oid").alias("event_oid"), b.alias("before_ms"), format_datetime(b).alias("before_text"))


@query(
    "format_datetime",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",
    ("FN-4",),
)
def format_datetime_q(spark, sf_dir):
    from recordset.functions.timefn import epoch_millis
    from recordset.plans.data import table

    e = table(spark, sf_dir, "events")
    return e.select("event_id", format_datetime(epoch_millis("ts")).alias("ts_text"))


# ---- metrics ----------------------------------------------------------------


@query("new_devices", _report_sql(["new_devices"], True, False), ("AGG-4", "FLT-17", "FN-5"))
def new_devices_q(spark, sf_dir):
    return _report(spark, sf_dir, ("new_device",))


@query("active_devices", _report_sql(["active_devices"], True, False), ("AGG-5",))
def active_devices_q(spark, sf_dir):
    return _report(spark, sf_dir, ("active_device",))


@query("apps_added", _report_sql(["apps_added"], True, False), ("AGG-6",))
def apps_added_q(spark, sf_dir):
    return _report(spark, sf_dir, ("app_added",))


@query(
    "apps_total",
    "WITH " + REPORT_CTES + "," + _SEG_SQL + " SELECT segment, count(*) AS apps_total FROM seg GROUP BY segment",
    ("AGG-7",),
)
def apps_total_q(spark, sf_dir):
    i = report_inputs(spark, sf_dir)
    return R.app_segments(i.app, i.td).groupBy("segment").agg(F.sum("mult").cast("bigint").alias("apps_total"))


@query(
    "daily_segment_report",
    _report_sql(["pushes", "activities", "new_devices", "active_devices"], False, False),
    ("AGG-2", "AGG-3", "AGG-4", "AGG-5"),
)
def daily_segment_report_q(spark, sf_dir):
    return _report(spark, sf_dir, ("push", "activity", "new_device", "active_device"), spine=False)


@query(
    "weekly_report_full",
    _report_sql(["pushes", "activities", "new_devices", "active_devices", "apps_added"], True, True),
    ("AGG-8", "SRC-14"),
)
def weekly_report_full_q(spark, sf_dir):
    return _report(spark, sf_dir, tuple(R.METRICS), spine=True, total=True)


def _lines_sql(as_of: str = REPORT_AS_OF) -> str:
    full = _report_sql(["pushes", "activities", "new_devices", "active_devices", "apps_added"], True, True, as_of)
    lab = "CASE r.segment WHEN 'app' THEN 'app' WHEN 'game' THEN 'game' ELSE 'mpush' END"
    idx = "CASE r.segment WHEN 'app' THEN 0 WHEN 'game' THEN 1 ELSE 2 END"
    parts = []
    for mi, fmt in enumerate(R.REPORT_LINE_FORMATS):
        names, _ = R._to_format_string(fmt)
        pieces = []
        rest = fmt
        for n in names:
            pre, rest = rest.split("{" + n + "}", 1)
            if pre:
                pieces.append("'" + pre.replace("'", "''") + "'")
            pieces.append(lab if n == "seg" else f"CAST(r.{n} AS VARCHAR)")
        if rest:
            pieces.append("'" + rest.replace("'", "''") + "'")
        parts.append(
            f"SELECT r.day, CAST({mi * 3} + {idx} + 1 AS INTEGER) AS line_no, " + " || ".join(pieces) + " AS text FROM r"
        )
    return "WITH r AS (" + full + ")\n" + "\nUNION ALL\n".join(parts)


@query("report_lines", _lines_sql(), ("SNK-18",))
def report_lines_q(spark, sf_dir):
    return R.report_lines(weekly_report_full_q(spark, sf_dir))


EARLIER_AS_OF = "2024-01-15"  # a week that the later run must leave alone


@query(
    "report_text_history",
    f"SELECT day, text FROM ({_lines_sql(EARLIER_AS_OF)}) UNION ALL SELECT day, text FROM ({_lines_sql()})",
    ("SNK-18",),
)
def report_text_history_q(spark, sf_dir):
    """Two runs of the report job into one folder, and what its text files then hold."""
    out = scratch_folder(spark, "report")
    for as_of in (EARLIER_AS_OF, REPORT_AS_OF):
        R.run_daily_report(report_inputs(spark, sf_dir), as_of, out, DAYS)
    return spark.read.schema("value string, day string").text(out).select("day", F.col("value").alias("text"))
