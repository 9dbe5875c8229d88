"""AGG-2..8 from kept counts: equal to the full report after any changes, reading the parts of the asked days only."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from recordset.functions.timefn import DAY_MS, date_ms
from recordset.operators import report as R
from recordset.operators import report_state as S
from test_report import inputs

AS_OF = "2024-01-31"
END = date_ms(AS_OF)
EVENT = "a string, ct bigint"
DV = "app string, ct bigint, mt bigint, tp string, token string"


def nested(df, name="app"):
    return df.withColumn(name, F.struct(F.col("a").alias("oid"))).drop("a")


def frames(spark, rows, change=False):
    """Frames of the five collections from lists of tuples; with ``change`` the last item of each says whether it came or went."""
    more = f", {S.CHANGE} int" if change else ""
    make = lambda name, schema: spark.createDataFrame(rows.get(name, []), schema + more)
    return dict(app=nested(make("app", EVENT), "_id"), td=nested(make("td", "a string, source string")), push=nested(make("push", EVENT)),
                activity=nested(make("activity", EVENT)), dv=make("dv", DV))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_collections_as_first_update(spark, tmp_out):
    i = inputs(spark)
    S.update_counts(spark, tmp_out, S.ReportChanges(i.app, i.td, i.push, i.activity, i.dv))
    assert rows_of(S.kept_report(spark, tmp_out, AS_OF)) == rows_of(R.segment_report(i, AS_OF))
    some = dict(metrics=("push", "app_added"), spine=False, with_total=False)
    assert rows_of(S.kept_report(spark, tmp_out, AS_OF, **some)) == rows_of(R.segment_report(i, AS_OF, **some))


def random_row(rnd, name):
    a = rnd.choice(["a1", "a1", "a2", "a3", "a4", None])
    t = rnd.choice([None, END - rnd.randrange(9) * DAY_MS, END - rnd.randrange(9 * DAY_MS), END - rnd.randrange(9) * DAY_MS - 1])
    if name == "td":
        return a, rnd.choice(["app", "game", "other", None])
    if name == "dv":
        return a, t, rnd.choice([None, END - rnd.randrange(9 * DAY_MS)]), rnd.choice(["a", "i", None]), rnd.choice(["", "x", None])
    return a, t


@pytest.mark.parametrize("seed", [1, 2])
def test_random_changes_equal_the_full_report(spark, tmp_out, seed):
    rnd = random.Random(seed)
    now = {n: [] for n in ("app", "td", "push", "activity", "dv")}
    for step in range(4):
        changes = {n: [] for n in now}
        for n, kept in now.items():
            for _ in range(rnd.randrange(3) and min(len(kept), rnd.randrange(6))):  # some rows go, from any earlier update
                changes[n].append((*kept.pop(rnd.randrange(len(kept))), -1))
            for _ in range(rnd.randrange(4, 40 if n != "app" else 6)):
                row = random_row(rnd, n)
                kept.append(row)
                changes[n].append((*row, rnd.choice([1, None])))
        S.update_counts(spark, tmp_out, S.ReportChanges(**frames(spark, changes, change=True)))
    full = R.ReportInputs(**frames(spark, now))
    for as_of in (AS_OF, "2024-01-27"):
        assert rows_of(S.kept_report(spark, tmp_out, as_of)) == rows_of(R.segment_report(full, as_of))


def test_late_event_moved_app_and_active_device_correct_past_days(spark, tmp_out):
    day = lambda n: END - n * DAY_MS + 5
    first = {"app": [("a1", 7)], "td": [("a1", "app")], "push": [("a1", day(3))], "dv": [("a1", None, day(3), "a", "")]}
    S.update_counts(spark, tmp_out, S.ReportChanges(**frames(spark, first)))
    S.update_counts(spark, tmp_out, S.ReportChanges(push=frames(spark, {"push": [("a1", day(6))]})["push"]))
    get = lambda: {(r.days_ago, r.segment): (r.pushes, r.active_devices, r.apps_total) for r in S.kept_report(spark, tmp_out, AS_OF).collect()}
    assert get()[3, "app"] == (1, 1, 1) and get()[6, "app"] == (1, 0, 1)
    moved = {"td": [("a1", "app", -1), ("a1", "game", 1)], "dv": [("a1", None, day(3), "a", "", -1), ("a1", None, day(1), "a", "", 1)]}
    S.update_counts(spark, tmp_out, S.ReportChanges(**frames(spark, moved, change=True)))
    r = get()
    assert r[3, "app"] == (0, 0, 0) and r[3, "game"] == (1, 0, 1) and r[6, "game"] == (1, 0, 1) and r[1, "game"] == (0, 1, 1)
    S.update_counts(spark, tmp_out, S.ReportChanges(td=frames(spark, {"td": [("a1", "game", -1)]}, change=True)["td"]))
    assert get()[6, "none"] == (1, 0, 1) and get()[6, "game"] == (0, 0, 0)


def test_report_reads_only_its_days_and_an_update_writes_only_its_own(spark, tmp_out):
    days = [{"push": [(f"a{j}", END - n * DAY_MS + 5 + j) for j in range(50)]} for n in range(12, 0, -1)]
    for d in days:
        state = S.update_counts(spark, tmp_out, S.ReportChanges(push=frames(spark, d)["push"]))
    assert len(state.counts) == 12 and all(len(own) == 1 for own in state.counts.values())
    files = S.kept_report(spark, tmp_out, AS_OF).inputFiles()
    read = {f.split("day_ms=")[1].split("/")[0] for f in files if "/counts/" in f}
    assert read == {str(END - n * DAY_MS) for n in range(1, 8)}
    before = state.counts
    state = S.update_counts(spark, tmp_out, S.ReportChanges(push=frames(spark, {"push": [("a1", END - 3 * DAY_MS + 9)]})["push"]))
    assert {d for d in state.counts if state.counts[d] != before[d]} == {END - 3 * DAY_MS}
    assert [p.rows for p in state.counts[END - 3 * DAY_MS]] == [50, 1]  # the day's counts are not rewritten for one event


def test_parts_of_a_day_stay_few_and_zero_counts_go(spark, tmp_out):
    for n in range(9):
        one = frames(spark, {"push": [(f"a{n}", END - DAY_MS + 5)]})["push"]
        state = S.update_counts(spark, tmp_out, S.ReportChanges(push=one))
    own = state.counts[END - DAY_MS]
    assert len(own) <= 4 and sum(p.rows for p in own) == 9
    gone = frames(spark, {"push": [(f"a{n}", END - DAY_MS + 5, -1) for n in range(9)]}, change=True)["push"]
    state = S.update_counts(spark, tmp_out, S.ReportChanges(push=gone))
    assert state.counts == {}
    dropped = S.drop_old_counts(spark, tmp_out, keep=1, grace_sec=-1)
    assert dropped and os.listdir(f"{tmp_out}/counts") == []


def test_replays_and_updates_at_one_time(spark, tmp_out):
    i = inputs(spark)
    S.update_counts(spark, tmp_out, S.ReportChanges(app=i.app, td=i.td), ("apps", 0))
    work = [(S.ReportChanges(push=i.push), ("push", 0)), (S.ReportChanges(activity=i.activity), ("activity", 0)), (S.ReportChanges(dv=i.dv), ("dv", 0)),
            (S.ReportChanges(push=i.push), ("push", 0))]
    threads = [threading.Thread(target=S.update_counts, args=(spark, tmp_out, *w)) for w in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for w in work:
        S.update_counts(spark, tmp_out, *w)
    assert rows_of(S.kept_report(spark, tmp_out, AS_OF)) == rows_of(R.segment_report(i, AS_OF))


def test_failed_update_changes_nothing(spark, tmp_out):
    i = inputs(spark)
    S.update_counts(spark, tmp_out, S.ReportChanges(i.app, i.td, i.push, i.activity, i.dv))
    bad = i.push.withColumn("ct", F.when(F.col("ct") > 0, F.raise_error(F.lit("no")).cast("bigint")))
    with pytest.raises(Exception, match="no"):
        S.update_counts(spark, tmp_out, S.ReportChanges(push=bad))
    assert rows_of(S.kept_report(spark, tmp_out, AS_OF)) == rows_of(R.segment_report(i, AS_OF))


def test_empty_state_and_empty_changes(spark, tmp_out):
    assert {tuple(r)[3:] for r in S.kept_report(spark, tmp_out, AS_OF).collect()} == {(0, 0, 0, 0, 0, 0)}
    S.update_counts(spark, tmp_out, S.ReportChanges(**frames(spark, {})))
    assert S.kept_report(spark, tmp_out, AS_OF).count() == 21
