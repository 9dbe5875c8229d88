"""Date and time helpers (FN-1..4, FN-12) as Column expressions.

All arithmetic is done on epoch milliseconds in UTC and never depends on the
session time zone: a TIMESTAMP_NTZ is turned into millis with date and
field arithmetic, so results are the same on any cluster.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
# Last millisecond of a day, 23:59:59.999, relative to its start.
DAY_LAST_MS = DAY_MS - 1


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ts: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ (or TIMESTAMP) column, truncated, zone free."""
    if isinstance(ts, str):
        # One parsed expression instead of a dozen Column calls.
        c = f"`{ts}`"
        return F.expr(
            f"CAST(unix_date(to_date({c})) AS BIGINT) * {DAY_MS} + CAST(hour({c}) AS BIGINT) * 3600000"
            f" + CAST(minute({c}) AS BIGINT) * 60000 + CAST(floor(date_part('SECOND', {c}) * 1000) AS BIGINT)"
        )
    secs = F.date_part(F.lit("SECOND"), ts)  # decimal seconds incl. fraction
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(DAY_MS)
        + F.hour(ts).cast("bigint") * 3_600_000
        + F.minute(ts).cast("bigint") * 60_000
        + F.floor(secs * 1000).cast("bigint")
    )


def day_start_ms(ms: Column | str) -> Column:
    """FN-1: start of the (UTC) day holding ``ms``, in epoch millis."""
    ms = _c(ms)
    return F.floor(ms / F.lit(DAY_MS)).cast("bigint") * F.lit(DAY_MS)


def day_end_ms(ms: Column | str) -> Column:
    """FN-2: 23:59:59.999 of the day holding ``ms``, in epoch millis."""
    return day_start_ms(ms) + F.lit(DAY_LAST_MS)


def in_day_exclusive(ms: Column | str, day_start: Column) -> Column:
    """FLT-16: ``start < ms < end`` with end = start + 86399999; both ends excluded."""
    ms = _c(ms)
    return (ms > day_start) & (ms < day_start + F.lit(DAY_LAST_MS))


def days_before_ms(ms: Column | str, n: int | Column) -> Column:
    """FN-3: the same time of day ``n`` days earlier (UTC has no DST)."""
    n = F.lit(n) if isinstance(n, int) else n
    return _c(ms) - n.cast("bigint") * F.lit(DAY_MS)


def millis_to_ntz(ms: Column | str) -> Column:
    """Epoch millis back to a zone-free TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def format_datetime(ms: Column | str) -> Column:
    """FN-4: ``yyyy-MM-dd HH:mm:ss`` of epoch millis, in UTC.

    Built from NTZ fields (date, hour, minute, second): ``date_format`` would
    pass through the session time zone.
    """
    t = millis_to_ntz(ms)

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return F.concat(
        F.to_date(t).cast("string"), F.lit(" "),
        two(F.hour(t)), F.lit(":"), two(F.minute(t)), F.lit(":"), two(F.floor(F.second(t))),
    )


def format_day(ms: Column | str) -> Column:
    """``yyyy-MM-dd`` of epoch millis, in UTC."""
    days = F.floor(_c(ms) / F.lit(DAY_MS)).cast("int")
    return F.date_add(F.lit(_dt.date(1970, 1, 1)), days).cast("string")


def date_ms(d: _dt.date | str) -> int:
    """Driver-side constant: epoch millis of midnight UTC of a date."""
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return (d - _dt.date(1970, 1, 1)).days * DAY_MS


def ttl_from_expiry(expiry: Column | str, as_of: int | Column) -> Column:
    """FN-12: time to live in seconds; a record that never expires (expiry 0) reports -1."""
    as_of = F.lit(as_of) if isinstance(as_of, int) else as_of
    e = _c(expiry)
    return F.when(e == 0, F.lit(-1)).otherwise(e - as_of).cast("int")
