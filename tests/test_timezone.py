"""Time results must not depend on the session time zone."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

NAMES = ["weekly_report_full", "day_bounds", "days_before", "format_datetime", "parse_times", "normalise_types"]


@pytest.mark.parametrize("name", NAMES)
def test_zone_free(spark, name):
    q = E.queries()[name]
    base = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other
