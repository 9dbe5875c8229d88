"""AGG-2..8, FLT-16..18, JN-5..7, PRJ-2, FN-1..4, SNK-18 on a tiny fixture with a brute-force check."""

from pyspark.sql import functions as F

from recordset.functions.timefn import date_ms
from recordset.operators import report as R

AS_OF = "2024-01-31"
D30 = date_ms("2024-01-30")
D29 = date_ms("2024-01-29")
LAST = 86_399_999


def inputs(spark):
    oid = lambda s: F.struct(F.lit(s).alias("oid"))
    app = spark.createDataFrame([("a1", D30 + 5), ("a2", D29 + 10), ("a3", D30), ("a4", 0)], "oid string, ct bigint") \
        .select(F.struct("oid").alias("_id"), "ct")
    # a1 has two 'app' td rows (counts twice), a2 is 'game', a3 has only 'other' (not none), a4 has none
    td = spark.createDataFrame([("a1", "app"), ("a1", "app"), ("a2", "game"), ("a3", "other")], "a string, source string") \
        .select(F.struct(F.col("a").alias("oid")).alias("app"), "source")
    push = spark.createDataFrame(
        [("a1", D30 + 1), ("a1", D30), ("a1", D30 + LAST), ("a2", D29 + 7), ("a4", D30 + 100), ("a1", D29 - 1)],
        "a string, ct bigint").select(F.struct(F.col("a").alias("oid")).alias("app"), "ct")
    activity = spark.createDataFrame([("a4", D29 + 1)], "a string, ct bigint") \
        .select(F.struct(F.col("a").alias("oid")).alias("app"), "ct")
    dv = spark.createDataFrame(
        [("a1", D30 + 1, None, "a", ""), ("a1", D30 + 2, None, "i", ""), ("a1", D30 + 3, None, "i", "tok"),
         ("a2", None, D30 + 9, "a", "t"), ("a4", D29 + 5, D29 + 6, "a", "")],
        "app string, ct bigint, mt bigint, tp string, token string")
    return R.ReportInputs(app=app, td=td, push=push, activity=activity, dv=dv)


def test_report_values(spark):
    r = {(x.day, x.segment): x.asDict() for x in R.segment_report(inputs(spark), AS_OF).collect()}
    assert len(r) == 21  # 7 days x 3 segments, zeros kept
    a30 = r[("2024-01-30", "app")]
    # push at +1 counts twice (two td rows); exact start and 23:59:59.999 are excluded
    assert a30["pushes"] == 2
    # dv: tp a, and tp i with a token -> 2 devices, times two td rows
    assert a30["new_devices"] == 4
    assert a30["apps_added"] == 2 and a30["apps_total"] == 2
    g29 = r[("2024-01-29", "game")]
    assert g29["pushes"] == 1 and g29["apps_added"] == 1 and g29["apps_total"] == 1
    assert r[("2024-01-30", "game")]["active_devices"] == 1
    n29, n30 = r[("2024-01-29", "none")], r[("2024-01-30", "none")]
    assert n29["activities"] == 1 and n29["new_devices"] == 1 and n29["active_devices"] == 1
    assert n30["pushes"] == 1 and n30["apps_total"] == 1
    # a3 created exactly at midnight: not "added"; it is in no segment at all
    assert sum(v["apps_added"] for v in r.values()) == 3
    assert r[("2024-01-24", "app")]["pushes"] == 0


def test_report_without_spine_only_days_with_facts(spark):
    rows = R.segment_report(inputs(spark), AS_OF, metrics=("push",), spine=False, with_total=False).collect()
    assert {(x.day, x.segment, x.pushes) for x in rows} == {
        ("2024-01-30", "app", 2), ("2024-01-29", "game", 1), ("2024-01-30", "none", 1)}


def test_segments(spark):
    i = inputs(spark)
    assert R.segment_rows(i.app, i.td, "app").count() == 2
    assert [x["_id"]["oid"] for x in R.unassigned_apps(i.app, i.td).collect()] == ["a4"]


def test_report_lines_and_text_sink(spark, tmp_out):
    lines = R.report_lines(R.segment_report(inputs(spark), AS_OF))
    day = sorted((x.line_no, x.text) for x in lines.where("day = '2024-01-30'").collect())
    assert len(day) == 15
    assert day[0] == (1, "app每日贡献push数:2")
    assert day[2] == (3, "mpush每日贡献push数:1")
    assert day[12] == (13, "app每日新增数:2,累计数:2")
    R.write_report_text(lines, f"{tmp_out}/report")
    txt = spark.read.text(f"{tmp_out}/report/day=2024-01-30").collect()
    assert len(txt) == 15


def test_run_daily_report(spark, tmp_out):
    rep = R.run_daily_report(inputs(spark), AS_OF, f"{tmp_out}/job")
    assert rep.count() == 21
    days = sorted(d for d in __import__("os").listdir(f"{tmp_out}/job") if d.startswith("day="))
    assert len(days) == 7 and days[0] == "day=2024-01-24"


def test_later_report_keeps_earlier_days(spark, tmp_out):
    import os

    for as_of in ("2024-01-15", AS_OF):
        R.run_daily_report(inputs(spark), as_of, f"{tmp_out}/job")
    assert len([d for d in os.listdir(f"{tmp_out}/job") if d.startswith("day=")]) == 14
