"""The weekly report from kept counts (AGG-2..8): updates with late events, moved apps and devices that were active again."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordset.functions.timefn import DAY_MS, date_ms
from recordset.operators.report_state import CHANGE, ReportChanges, kept_report, update_counts
from recordset.plans.data import REPORT_AS_OF, report_inputs
from recordset.plans.q_report import DAYS, _report_sql
from recordset.plans.registry import query
from recordset.session import scratch_folder

LAST_DAYS = date_ms("2024-01-28")  # events from here on come with the second update, unless they are late


def changed(before, after):
    """Rows that went and came as one frame of changes."""
    return before.withColumn(CHANGE, F.lit(-1)).unionByName(after.withColumn(CHANGE, F.lit(1)))


@query(
    "report_incremental",
    _report_sql(["pushes", "activities", "new_devices", "active_devices", "apps_added"], True, True),
    ("AGG-2", "AGG-3", "AGG-4", "AGG-5", "AGG-6", "AGG-7", "AGG-8"),
)
def report_incremental_q(spark, sf_dir):
    """All collections in three updates, after which the kept counts give the report of a full run.

    The first has the events up to a day, all apps and all td rows, a third of them in another segment than later, and devices
    last active a day before; the second the days since (twice, as a replay); the third events that come late, the td rows'
    moves and the devices' newer days.
    """
    i = report_inputs(spark, sf_dir)
    root = scratch_folder(spark, "counts")
    oid = F.col("_id.oid").cast("long")
    late = oid % 10 == 0
    early = F.col("ct") < LAST_DAYS
    moves = oid % 3 == 0
    td_then = i.td.withColumn("source", F.when(moves, F.when(F.col("source") == "app", "game").otherwise("app")).otherwise(F.col("source")))
    dv_then = i.dv.withColumn("mt", F.col("mt") - F.lit(DAY_MS))
    update_counts(spark, root, ReportChanges(i.app, td_then, i.push.where(early & ~late), i.activity.where(early & ~late), dv_then), ("feed", 0))
    since = ReportChanges(push=i.push.where(~early & ~late), activity=i.activity.where(~early & ~late))
    for _ in range(2):
        update_counts(spark, root, since, ("feed", 1))
    update_counts(spark, root, ReportChanges(
        td=changed(td_then.where(moves), i.td.where(moves)), push=i.push.where(late), activity=i.activity.where(late),
        dv=changed(dv_then.where("mt is not null"), i.dv.where("mt is not null"))), ("feed", 2))
    return kept_report(spark, root, REPORT_AS_OF, DAYS)
