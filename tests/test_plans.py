"""Plan-shape guards over the whole catalogue (no cross joins, no Python in the hot path)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_no_cross_join_or_python(spark, name):
    plan = plan_of(E.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_report_pre_aggregates_before_shuffle(spark):
    plan = plan_of(E.queries()["weekly_report_full"](spark, SF_SMALL))
    # The event counts are partially aggregated map-side before their exchange.
    assert "partial_count(1)" in plan
    assert plan.index("partial_count(1)") > plan.index("Exchange hashpartitioning(oid")


def formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scans_are_pruned_and_pushed(spark):
    plan = formatted(E.queries()["pushdown_scan"](spark, SF_SMALL))
    assert "GreaterThan(o_totalprice,100000.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
