"""Segment / day activity report (AGG-2..8, JN-5..7, FLT-16..18, SNK-18).

Segments of apps:
  * ``app``  = app JOIN td ON td.app = app._id WHERE td.source = 'app'
  * ``game`` = the same with source 'game'
  * ``none`` = apps with no td row at all (NOT EXISTS)
An app with k matching td rows counts k times in its segment, as the plain
inner joins do.

Instead of one job per (day, segment, metric), the report is a single plan:
every fact source is cut to the report window (a range on the raw time
column, pushed into the scan), pre-aggregated per (app, day, metric) with
map-side partial aggregation (so a hot app costs one row per task, not a
third of the shuffle), then joined once to the app rows with their segment
multiplicities (td reduced to one row per app first), which is app-sized on
both sides. Event counts, app rows (added / total) and a day x segment spine
that keeps zero counts are rows of one union ending in a single
``groupBy(day, segment)``.

Inputs are lazy DataFrames: a collection stored partitioned by day can be
narrowed by its partition column before it is passed in, and the scan then
reads only the report's days.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordset.functions.timefn import DAY_LAST_MS, DAY_MS, date_ms, format_day
from recordset.session import ensure_checkpoint_dir

SEGMENTS = ("app", "game", "none")

# Metric name -> output column.
METRICS = {
    "push": "pushes",
    "activity": "activities",
    "new_device": "new_devices",
    "active_device": "active_devices",
    "app_added": "apps_added",
}


@dataclass(frozen=True)
class ReportInputs:
    """The five collections of the report.

    app:      ``_id`` STRUCT<oid STRING>, ``ct`` BIGINT (epoch ms)
    td:       ``app`` STRUCT<oid STRING>, ``source`` STRING
    push:     ``app`` STRUCT<oid STRING>, ``ct`` BIGINT
    activity: ``app`` STRUCT<oid STRING>, ``ct`` BIGINT
    dv:       ``app`` STRING, ``ct`` BIGINT, ``mt`` BIGINT, ``tp`` STRING, ``token`` STRING
    """

    app: DataFrame
    td: DataFrame
    push: DataFrame
    activity: DataFrame
    dv: DataFrame


def countable_device() -> Column:
    """FLT-17: ``ct is not null and (tp = 'a' or (tp = 'i' and length(token) > 0))``."""
    return F.col("ct").isNotNull() & (
        (F.col("tp") == "a") | ((F.col("tp") == "i") & (F.length("token") > 0))
    )


def segment_rows(app: DataFrame, td: DataFrame, source: str) -> DataFrame:
    """JN-5 / FLT-18 / PRJ-2: app rows joined with td rows of one source (fans out)."""
    t = td.where(F.col("source") == source).drop("_id")
    return app.join(t, app["_id"] == t["app"], "inner")


def unassigned_apps(app: DataFrame, td: DataFrame) -> DataFrame:
    """JN-7: apps with no td row (NOT EXISTS), as a left anti join."""
    keys = td.select(F.col("app").alias("__td_app")).where(F.col("__td_app").isNotNull())
    return app.join(keys, app["_id"] == keys["__td_app"], "left_anti")


def app_segments(app: DataFrame, td: DataFrame) -> DataFrame:
    """Per app row: (oid, ct, segment, mult) with mult = rows it has in that segment.

    td is first reduced to one row per app (partial aggregation), so the join
    is app-sized on both sides whatever the td fan-out or skew.
    """
    td_counts = (
        td.where(F.col("app").isNotNull())
        .groupBy(F.col("app.oid").alias("__oid"))
        .agg(
            F.count_if(F.col("source") == "app").alias("__n_app"),
            F.count_if(F.col("source") == "game").alias("__n_game"),
            F.count(F.lit(1)).alias("__n_any"),
        )
    )
    a = app.select(F.col("_id.oid").alias("oid"), F.col("ct"))
    return segments_of_counts(a, td_counts)


def segments_of_counts(a: DataFrame, td_counts: DataFrame, rows: Column | None = None) -> DataFrame:
    """(oid, ct, segment, mult) of app rows (oid, ct), each standing for ``rows`` rows, and td counts (__oid, __n_app, __n_game, __n_any)."""
    j = a.join(td_counts, a["oid"] == td_counts["__oid"], "left")
    rows = F.lit(1) if rows is None else rows
    seg = F.explode(
        F.array(
            F.struct(F.lit("app").alias("segment"), (rows * F.coalesce("__n_app", F.lit(0))).alias("mult")),
            F.struct(F.lit("game").alias("segment"), (rows * F.coalesce("__n_game", F.lit(0))).alias("mult")),
            F.struct(
                F.lit("none").alias("segment"),
                F.when(F.col("__n_any").isNull(), rows).otherwise(F.lit(0)).cast("bigint").alias("mult"),
            ),
        )
    ).alias("s")
    return j.select("oid", "ct", seg).select("oid", "ct", "s.segment", "s.mult").where(F.col("mult") > 0)


def _window_facts(df: DataFrame, oid: Column, t: str, metric: str, lo: int, hi: int) -> DataFrame:
    # The range on the raw column reaches the parquet scan as a pushed filter.
    return df.where((F.col(t) > lo) & (F.col(t) < hi)).select(
        oid.alias("oid"), F.lit(metric).alias("metric"), F.col(t).alias("t")
    )


def _device_facts(dv: DataFrame, facts: list[tuple[str, str, Column]], lo: int, hi: int) -> DataFrame:
    """New (by ``ct``) and active (by ``mt``) devices from a single scan of the device set.

    The OR of the window ranges reaches the parquet scan; each record then
    yields one fact per metric it qualifies for.
    """
    in_window = [(F.col(t) > lo) & (F.col(t) < hi) for _, t, _ in facts]
    pushed = reduce(lambda a, b: a | b, in_window)
    entries = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.when(ok & w, F.col(t)).alias("t"))
        for (m, t, ok), w in zip(facts, in_window)
    ])
    return (
        dv.where(pushed)
        .select(F.col("app").alias("oid"), F.explode(entries).alias("e"))
        .select("oid", "e.metric", "e.t")
        .where(F.col("t").isNotNull())
    )


def day_bucket(facts: DataFrame, *further: Column) -> DataFrame:
    """Day of each fact; drop the first and last millisecond of every day (FLT-16)."""
    day = (F.floor(F.col("t") / F.lit(DAY_MS)) * F.lit(DAY_MS)).cast("bigint")
    off = F.col("t") - day
    return facts.select("oid", "metric", day.alias("day_ms"), off.alias("off"), *further).where(
        (F.col("off") > 0) & (F.col("off") < DAY_LAST_MS)
    )


def segment_report(
    inputs: ReportInputs,
    as_of: _dt.date | str,
    days: int = 7,
    metrics: tuple[str, ...] = tuple(METRICS),
    spine: bool = True,
    with_total: bool = True,
) -> DataFrame:
    """Counts per (day, segment) for the ``days`` days before ``as_of``.

    Output: day (yyyy-MM-dd), days_ago (1..days), segment, one BIGINT column per
    metric (see ``METRICS``) and ``apps_total`` (all apps of the segment, not
    limited to the day, as the reference counts it).

    Every contribution (event counts, app rows, spine) is a row of one wide
    union, so the report ends in a single ``groupBy(day, segment)`` with
    partial aggregation; there is no join on the (tiny) result.
    """
    end = date_ms(as_of)  # exclusive upper bound: midnight of as_of
    lo, hi = end - days * DAY_MS, end
    segs = app_segments(inputs.app, inputs.td)
    event_parts = []
    if "push" in metrics:
        event_parts.append(_window_facts(inputs.push, F.col("app.oid"), "ct", "push", lo, hi))
    if "activity" in metrics:
        event_parts.append(_window_facts(inputs.activity, F.col("app.oid"), "ct", "activity", lo, hi))
    dv_facts = []
    if "new_device" in metrics:
        dv_facts.append(("new_device", "ct", countable_device()))
    if "active_device" in metrics:
        dv_facts.append(("active_device", "mt", F.col("mt").isNotNull()))
    if dv_facts:
        event_parts.append(_device_facts(inputs.dv, dv_facts, lo, hi))

    per_app = None
    if event_parts:
        facts = day_bucket(reduce(DataFrame.unionByName, event_parts))
        # Pre-aggregate before the join: at most apps x days x metrics rows.
        per_app = facts.groupBy("oid", "day_ms", "metric").agg(F.count(F.lit(1)).alias("n"))
    return report_of_counts(per_app, segs, end, days, metrics, spine, with_total)


def report_of_counts(
    per_app: DataFrame | None,
    segs: DataFrame,
    end: int,
    days: int,
    metrics: tuple[str, ...] = tuple(METRICS),
    spine: bool = True,
    with_total: bool = True,
) -> DataFrame:
    """The report of ``segment_report`` from counts (oid, day_ms, metric, n) of its days and app rows (oid, ct, segment, mult).

    A count may come in several rows, which add up.
    """
    lo, hi = end - days * DAY_MS, end
    cols = [METRICS[m] for m in METRICS if m in metrics] + (["apps_total"] if with_total else [])
    zero = F.lit(0).cast("bigint")

    def wide(df: DataFrame, values: dict[str, Column], facts: Column) -> DataFrame:
        return df.select(
            F.col("day_ms").cast("bigint").alias("day_ms"),
            "segment",
            *[values.get(c, zero).cast("bigint").alias(c) for c in cols],
            facts.cast("bigint").alias("__facts"),
        )

    parts = []
    if per_app is not None:
        # Joined with every app row of the segment as it is: summing n * mult
        # over app rows equals n * (sum of mult), so no extra aggregation of
        # the segment rows (and no extra shuffle) is needed.
        j = per_app.join(segs.select("oid", "segment", "mult"), "oid")
        n = F.col("n") * F.col("mult")
        parts.append(
            wide(j, {METRICS[m]: F.when(F.col("metric") == m, n).otherwise(zero)
                     for m in METRICS if m in metrics and m != "app_added"}, n)
        )
    if with_total:
        # AGG-7 and AGG-6 together: every app row adds its multiplicity to the
        # total of each report day, and to "added" on the day it was created.
        per_day = segs.select(
            "segment", "mult", "ct", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("__d")
        ).withColumn("day_ms", F.lit(lo) + F.col("__d").cast("bigint") * F.lit(DAY_MS))
        added = F.when(in_day(F.col("ct"), F.col("day_ms")), F.col("mult")).otherwise(zero)
        vals = {"apps_total": F.col("mult")}
        if "app_added" in metrics:
            vals["apps_added"] = added
        parts.append(wide(per_day, vals, added if "app_added" in metrics else zero))
    elif "app_added" in metrics:
        # AGG-6 alone: apps created in the window, on their day.
        day = (F.floor(F.col("ct") / F.lit(DAY_MS)) * F.lit(DAY_MS)).cast("bigint")
        a = segs.where((F.col("ct") > lo) & (F.col("ct") < hi)).withColumn("day_ms", day)
        a = a.where(in_day(F.col("ct"), F.col("day_ms")))
        parts.append(wide(a, {"apps_added": F.col("mult")}, F.col("mult")))

    if spine:
        parts.append(wide(day_segment_spine(segs.sparkSession, end, days), {}, zero))

    long = reduce(DataFrame.unionByName, parts)
    agg = long.groupBy("day_ms", "segment").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in cols], F.sum("__facts").alias("__facts")
    )
    if not spine:
        agg = agg.where(F.col("__facts") > 0)
    return agg.select(
        format_day(F.col("day_ms")).alias("day"),
        ((F.lit(end) - F.col("day_ms")) / F.lit(DAY_MS)).cast("int").alias("days_ago"),
        "segment",
        *cols,
    )


def in_day(ms: Column, day_ms: Column) -> Column:
    """FLT-16 against a day start: strictly after it and strictly before 23:59:59.999."""
    return (ms > day_ms) & (ms < day_ms + F.lit(DAY_LAST_MS))


def day_segment_spine(spark: SparkSession, end_ms: int, days: int) -> DataFrame:
    """(day_ms, segment) for every report day and segment, built without a cross join."""
    n = len(SEGMENTS)
    seg_arr = F.array(*[F.lit(s) for s in SEGMENTS])
    return spark.range(days * n, numPartitions=1).select(
        (F.lit(end_ms) - (F.floor(F.col("id") / n) + 1).cast("bigint") * F.lit(DAY_MS)).alias("day_ms"),
        F.element_at(seg_arr, (F.col("id") % n + 1).cast("int")).alias("segment"),
    )


# The labels of the reference's report file, one line per
# (segment, metric) in this order; the segment "none" prints as "mpush".
REPORT_SEGMENT_LABELS = {"app": "app", "game": "game", "none": "mpush"}
REPORT_LINE_FORMATS = [
    "{seg}每日贡献push数:{pushes}",
    "{seg}每日贡献activity数:{activities}",
    "{seg}每日贡献的新增token数:{new_devices}",
    "{seg}每日贡献的活跃设备数:{active_devices}",
    "{seg}每日新增数:{apps_added},累计数:{apps_total}",
]


def report_lines(report: DataFrame) -> DataFrame:
    """SNK-18: the report as (day, line_no, text), 15 lines a day.

    Lines are grouped by metric, then segment (app, game, none) within it,
    as the reference writes them. Each report row becomes its five lines
    with one ``explode`` (no union of report copies).
    """
    seg_label = F.create_map(*[x for s, lab in REPORT_SEGMENT_LABELS.items() for x in (F.lit(s), F.lit(lab))])
    seg_idx = F.create_map(*[x for i, s in enumerate(SEGMENTS) for x in (F.lit(s), F.lit(i))])
    lines = []
    for mi, fmt in enumerate(REPORT_LINE_FORMATS):
        names, spark_fmt = _to_format_string(fmt)
        args = [seg_label[F.col("segment")] if n == "seg" else F.col(n).cast("string") for n in names]
        lines.append(
            F.struct(
                (F.lit(mi * len(SEGMENTS)) + seg_idx[F.col("segment")] + 1).cast("int").alias("line_no"),
                F.format_string(spark_fmt, *args).alias("text"),
            )
        )
    return report.select("day", F.explode(F.array(*lines)).alias("l")).select("day", "l.line_no", "l.text")


def _to_format_string(fmt: str) -> tuple[list[str], str]:
    names: list[str] = []
    out = []
    i = 0
    while i < len(fmt):
        if fmt[i] == "{":
            j = fmt.index("}", i)
            names.append(fmt[i + 1 : j])
            out.append("%s")
            i = j + 1
        else:
            out.append(fmt[i].replace("%", "%%"))
            i += 1
    return names, "".join(out)


def write_report_text(lines: DataFrame, path: str) -> None:
    """SNK-18: one text folder per day (``day=yyyy-MM-dd``), lines in order; days that are not among the lines keep theirs."""
    (
        lines.repartition("day")
        .sortWithinPartitions("day", "line_no")
        .select("day", "text")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .text(path)
    )


def run_daily_report(inputs: ReportInputs, as_of: _dt.date | str, out_path: str, days: int = 7) -> DataFrame:
    """The report job end to end: counts for the ``days`` days before ``as_of``,
    written as 15 labelled lines per day under ``out_path/day=<yyyy-MM-dd>``.

    Returns the report rows (three a day), which are computed once and kept in the checkpoint folder.
    """
    ensure_checkpoint_dir(inputs.app.sparkSession)
    report = segment_report(inputs, as_of, days).checkpoint()
    write_report_text(report_lines(report), out_path)
    return report
