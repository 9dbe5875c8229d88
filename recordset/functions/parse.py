"""Text parsing helpers for delimited ingest (FN-6..9).

All are Column expressions (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordset.functions.timefn import DAY_MS


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line: Column | str, sep: str = ",", quote: str = '"') -> Column:
    """FN-6: strip quotes, then split on the separator (no quoted separators, as in the source)."""
    return F.split(F.replace(_c(line), F.lit(quote), F.lit("")), sep)


def field(fields: Column, i: int) -> Column:
    """1-based field; null when the line is short."""
    return F.try_element_at(fields, F.lit(i))


def parse_int(s: Column | str) -> Column:
    """FN-7: integer text; malformed -> null."""
    return F.trim(_c(s)).try_cast("int")


def parse_double_or_zero(s: Column | str) -> Column:
    """FN-7: double text; empty -> 0.0."""
    s = _c(s)
    return F.coalesce(F.nullif(F.trim(s), F.lit("")).try_cast("double"), F.lit(0.0))


def parse_time_ms(date: Column | str, hhmm: Column | str) -> Column:
    """FN-8: epoch millis of ``yyyy-MM-dd`` + ``HHmm``.

    Empty time -> null; ``2400`` -> ``0000`` of the same date.
    """
    t = F.trim(_c(hhmm))
    t = F.when(t == "2400", F.lit("0000")).otherwise(t)
    # Date and clock arithmetic, so the result does not depend on the session zone.
    day = F.unix_date(F.try_to_date(_c(date), "yyyy-MM-dd")).cast("bigint") * F.lit(DAY_MS)
    hh = F.substring(t, 1, 2).try_cast("bigint")
    mm = F.substring(t, 3, 2).try_cast("bigint")
    ok = (F.length(t) == 4) & hh.between(0, 23) & mm.between(0, 59)
    return F.when(ok, day + hh * 3_600_000 + mm * 60_000).otherwise(F.lit(None).cast("bigint"))


def compose_key(carrier: Column | str, number: Column | str, date: Column | str, dep: Column | str) -> Column:
    """FN-9: ``carrier+number:date:dep``; an empty departure becomes ``XXXX``."""
    d = F.coalesce(F.nullif(_c(dep), F.lit("")), F.lit("XXXX"))
    return F.concat(_c(carrier), _c(number), F.lit(":"), _c(date), F.lit(":"), d)
