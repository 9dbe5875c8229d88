"""Kept counts of the segment report, brought up to date by what changed (AGG-2..8).

``segment_report`` reads seven days of events for every report. Here each event is read once, when it
arrives, and its count is kept; a report then reads the counts of its days and no events.

    <root>/_manifests/m-<version>.json              which parts make up the state, see ``sources.layout.publish``
    <root>/counts/w=<id>/day_ms=<day>/part-*        (oid, metric, n): counts by app, day and metric
    <root>/apps/w=<id>/part-*                       (oid, is_app, ct, n, n_app, n_game): app rows and td rows by app

All of it is counts that add up, so an update stores only the counts of its own rows:

* A row that came counts +1, a row that went -1 (column ``__change``; without it all rows came). A changed row is its
  old form with -1 and its new form with +1, so a device active on a later day leaves the day it was counted on.
* A late event adds to its own day, however old.
* Segments are not part of the counts by app and day: a report joins them with the apps as they are now, so an app that
  moved to another segment takes its past days along, as in a full run.

A day's parts are folded when a younger one has grown to half of its elder, so a day has parts in the logarithm of its rows
and each count is rewritten as often. Nothing is ever gathered by app or day in one task: counts are aggregated map-side
first, and AQE cuts a large day into several files.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.functions.timefn import DAY_MS, date_ms
from recordset.operators.report import METRICS, countable_device, day_bucket, report_of_counts, segments_of_counts
from recordset.sources.layout import PublishConflict, delete_path, path_entries, path_exists, publish, read_published, versions, write_id

CHANGE = "__change"
COUNTS = T.StructType([T.StructField("oid", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("day_ms", T.LongType())])
APPS = T.StructType([T.StructField("oid", T.StringType()), T.StructField("is_app", T.BooleanType()), T.StructField("ct", T.LongType()),
                     T.StructField("n", T.LongType()), T.StructField("n_app", T.LongType()), T.StructField("n_game", T.LongType())])


@dataclass(frozen=True)
class ReportChanges:
    """What changed in the collections of ``ReportInputs`` (the same columns, and ``__change`` where rows went); None: nothing."""

    app: DataFrame | None = None
    td: DataFrame | None = None
    push: DataFrame | None = None
    activity: DataFrame | None = None
    dv: DataFrame | None = None


@dataclass(frozen=True)
class Part:
    write: str
    rows: int


@dataclass(frozen=True)
class Kept:
    """One version of the state: the parts of each day and of the apps, by age, and the last batch of each stream."""

    version: int = 0
    counts: dict[int, tuple[Part, ...]] = field(default_factory=dict)
    apps: tuple[Part, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Kept:
        d = json.loads(text)
        return Kept(d["version"], {int(k): tuple(Part(**p) for p in v) for k, v in d["counts"].items()}, tuple(Part(**p) for p in d["apps"]), d["batches"])

    def writes(self) -> set[str]:
        return {p.write for own in (self.apps, *self.counts.values()) for p in own}


def latest_state(spark: SparkSession, root: str) -> Kept:
    found = versions(spark, root)
    return Kept.from_json(read_published(spark, root, found[-1])) if found else Kept()


def _change(df: DataFrame) -> Column:
    return F.coalesce(F.col(CHANGE).cast("bigint"), F.lit(1)) if CHANGE in df.columns else F.lit(1).cast("bigint")


def _event_counts(changes: ReportChanges) -> DataFrame | None:
    """(oid, metric, n, day_ms) of the changed events; every collection is read once."""
    parts = [
        df.select(F.col("app.oid").alias("oid"), F.lit(metric).alias("metric"), F.col("ct").alias("t"), _change(df).alias("c"))
        for df, metric in ((changes.push, "push"), (changes.activity, "activity")) if df is not None
    ]
    if changes.dv is not None:
        times = F.array(
            F.struct(F.lit("new_device").alias("metric"), F.when(countable_device(), F.col("ct")).alias("t")),
            F.struct(F.lit("active_device").alias("metric"), F.col("mt").alias("t")),
        )
        dv = changes.dv.select(F.col("app").alias("oid"), F.explode(times).alias("e"), _change(changes.dv).alias("c"))
        parts.append(dv.select("oid", "e.metric", "e.t", "c"))
    if not parts:
        return None
    facts = reduce(DataFrame.unionByName, parts).where(F.col("t").isNotNull() & F.col("oid").isNotNull())
    return _sum_counts(day_bucket(facts, F.col("c").alias("n")))


def _sum_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("oid", "metric", "day_ms").agg(F.sum("n").alias("n")).where("n != 0").select(*COUNTS.fieldNames())


def _app_counts(changes: ReportChanges) -> DataFrame | None:
    parts = []
    none = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    if changes.app is not None:
        parts.append(changes.app.select(
            F.col("_id.oid").alias("oid"), F.lit(True).alias("is_app"), F.col("ct").cast("bigint").alias("ct"), _change(changes.app).alias("n"),
            zero.alias("n_app"), zero.alias("n_game")))
    if changes.td is not None:
        n = _change(changes.td)
        of = lambda s: F.when(F.col("source") == s, n).otherwise(zero)
        parts.append(changes.td.select(
            F.col("app.oid").alias("oid"), F.lit(False).alias("is_app"), none.alias("ct"), n.alias("n"), of("app").alias("n_app"), of("game").alias("n_game")))
    return _sum_apps(reduce(DataFrame.unionByName, parts)) if parts else None


def _sum_apps(df: DataFrame) -> DataFrame:
    sums = df.groupBy("oid", "is_app", "ct").agg(*[F.sum(c).alias(c) for c in ("n", "n_app", "n_game")])
    return sums.where("n != 0 or n_app != 0 or n_game != 0").select(*APPS.fieldNames())


def _write_counts(spark: SparkSession, root: str, df: DataFrame, write: str) -> dict[int, Part]:
    """Store counts by day, a large day in several files; the part made for each day."""
    folder = f"{root}/counts/w={write}"
    df.hint("rebalance", "day_ms").write.partitionBy("day_ms").parquet(folder)
    found = spark.read.schema(COUNTS).parquet(folder).groupBy("day_ms").agg(F.count(F.lit(1))).collect()
    return {day: Part(write, n) for day, n in found}


def _write_apps(spark: SparkSession, root: str, df: DataFrame, write: str) -> tuple[Part, ...]:
    folder = f"{root}/apps/w={write}"
    df.write.parquet(folder)
    n = spark.read.schema(APPS).parquet(folder).count()
    return (Part(write, n),) if n else ()


def _read_counts(spark: SparkSession, root: str, parts: dict[int, tuple[Part, ...]]) -> DataFrame:
    paths = [f"{root}/counts/w={p.write}/day_ms={day}" for day, own in sorted(parts.items()) for p in own]
    if not paths:
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).option("basePath", f"{root}/counts").parquet(*paths).select(*COUNTS.fieldNames())


def _read_apps(spark: SparkSession, root: str, parts: tuple[Part, ...]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], APPS)
    return spark.read.schema(APPS).parquet(*(f"{root}/apps/w={p.write}" for p in parts))


def update_counts(spark: SparkSession, root: str, changes: ReportChanges, batch: tuple[str, int] | None = None) -> Kept:
    """Add what changed to the state at ``root`` (begun when there is none); the version that holds it.

    The changes are evaluated once. ``batch`` is (stream, number) of a feed whose batches are numbered upwards: one that
    is not above the stream's last is a replay and changes nothing. Of two updates at a time both count: the one that
    comes second adds its parts to the other's version. A failed update leaves the last version as it was.
    Events without a time or an app are in no report and not counted.
    """
    root = root.rstrip("/")
    state = latest_state(spark, root)
    if batch and state.batches.get(batch[0], -1) >= batch[1]:
        return state
    write = write_id(state.version)
    events, apps = _event_counts(changes), _app_counts(changes)
    new_counts = _write_counts(spark, root, events, write) if events is not None else {}
    new_apps = _write_apps(spark, root, apps, write) if apps is not None else ()
    while True:
        counts = dict(state.counts)
        for day, part in new_counts.items():
            counts[day] = (*counts.get(day, ()), part)
        batches = state.batches | ({batch[0]: batch[1]} if batch else {})
        made = Kept(state.version + 1, counts, state.apps + new_apps, batches)
        try:
            publish(spark, root, made)
            break
        except PublishConflict:
            state = latest_state(spark, root)
            if batch and state.batches.get(batch[0], -1) >= batch[1]:
                return state
    return _fold(spark, root, made)


def _young(parts: tuple[Part, ...]) -> int:
    """How many of the youngest parts are to be folded into one: as long as they have half the rows of the next elder."""
    n, rows = 1, parts[-1].rows
    while n < len(parts) and 2 * rows >= parts[-n - 1].rows:
        rows += parts[-n - 1].rows
        n += 1
    return n


def _fold(spark: SparkSession, root: str, state: Kept) -> Kept:
    """Fold grown parts; when another update came in between, its version stands and the next update folds."""
    days = {day: own[-_young(own):] for day, own in state.counts.items() if _young(own) > 1}
    apps = state.apps[-_young(state.apps):] if state.apps and _young(state.apps) > 1 else ()
    if not days and not apps:
        return state
    write = write_id(state.version)
    counts, all_apps = dict(state.counts), state.apps
    if days:
        folded = _write_counts(spark, root, _sum_counts(_read_counts(spark, root, days)), write)
        for day, own in days.items():
            counts[day] = counts[day][: -len(own)] + ((folded[day],) if day in folded else ())
    if apps:
        all_apps = state.apps[: -len(apps)] + _write_apps(spark, root, _sum_apps(_read_apps(spark, root, apps)), write)
    made = replace(state, version=state.version + 1, counts={d: own for d, own in counts.items() if own}, apps=all_apps)
    try:
        publish(spark, root, made)
    except PublishConflict:
        return state
    return made


def kept_segments(spark: SparkSession, root: str, state: Kept) -> DataFrame:
    """App rows with their segments as ``app_segments`` gives them, rows of one app and time as one row with their sum."""
    stored = _read_apps(spark, root.rstrip("/"), state.apps)
    apps = stored.where("is_app").groupBy("oid", "ct").agg(F.sum("n").alias("__rows")).where("__rows != 0")
    td = stored.where("not is_app and oid is not null").groupBy(F.col("oid").alias("__oid")).agg(
        F.sum("n_app").alias("__n_app"), F.sum("n_game").alias("__n_game"), F.sum("n").alias("__n_any")).where("__n_any != 0")
    return segments_of_counts(apps, td, F.col("__rows"))


def kept_report(
    spark: SparkSession,
    root: str,
    as_of: _dt.date | str,
    days: int = 7,
    metrics: tuple[str, ...] = tuple(METRICS),
    spine: bool = True,
    with_total: bool = True,
    version: int | None = None,
) -> DataFrame:
    """``segment_report`` from the kept counts: the same rows and columns, reading the parts of its days only.

    ``version`` asks for an earlier version of the state that is still kept.
    """
    root = root.rstrip("/")
    state = latest_state(spark, root) if version is None else Kept.from_json(read_published(spark, root, version))
    end = date_ms(as_of)
    asked = {day: own for day, own in state.counts.items() if end - days * DAY_MS <= day < end}
    counts = _read_counts(spark, root, asked).where(F.col("metric").isin(*metrics))
    return report_of_counts(counts, kept_segments(spark, root, state), end, days, metrics, spine, with_total)


def drop_old_counts(spark: SparkSession, root: str, keep: int = 2, grace_sec: int = 86_400) -> list[str]:
    """Delete all but the newest ``keep`` versions, and parts that none of these names and that are older than ``grace_sec``.

    The grace must exceed the longest update, ``keep`` must cover the longest report. Returns what was deleted.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    root = root.rstrip("/")
    found = versions(spark, root)
    named = set().union(*(Kept.from_json(read_published(spark, root, v)).writes() for v in found[-keep:]))
    before = spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - grace_sec * 1000
    gone = [f"{root}/_manifests/m-{v:010d}.json" for v in found[:-keep]]
    for table in ("counts", "apps"):
        if path_exists(spark, f"{root}/{table}"):
            gone += [f"{root}/{table}/{name}" for name, time in path_entries(spark, f"{root}/{table}/w=*")
                     if name.removeprefix("w=") not in named and time <= before]
    for path in gone:
        delete_path(spark, path)
    return gone
