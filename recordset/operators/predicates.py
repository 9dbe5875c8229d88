"""Record filters (FLT-1..14, FLT-19) as plain Column predicates.

Everything here returns a ``Column`` so Catalyst can push what parquet
supports (=, <, <=, >, >=, between, prefix, suffix, not-null, IN, AND/OR)
into the scan and evaluate the rest right after it. The only rule that is
not plain SQL is the reference's type-dispatched equality: on a list bin it
means "contains", on a map bin "has key" (FLT-2, FLT-3).
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bin_eq(df: DataFrame, name: str, value: Any) -> Column:
    """FLT-1..3: equality dispatched on the bin's type."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.ArrayType):
        return F.array_contains(c, F.lit(value))
    if isinstance(dt, T.MapType):
        return F.map_contains_key(c, F.lit(value))
    return c == F.lit(value)


_OPS = {
    "=": lambda c, v: c == v,
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
}


def compare(name: str, op: str, value: Any) -> Column:
    """FLT-4..7 (and FLT-1 on scalars)."""
    try:
        return _OPS[op](F.col(name), F.lit(value))
    except KeyError:
        raise ValueError(f"unknown comparison {op!r}") from None


def between(name: str, low: Any, high: Any) -> Column:
    """FLT-8: inclusive at both ends."""
    return F.col(name).between(F.lit(low), F.lit(high))


def starts_with(name: str, prefix: str) -> Column:
    """FLT-9."""
    return F.col(name).startswith(prefix)


def ends_with(name: str, suffix: str) -> Column:
    """FLT-10."""
    return F.col(name).endswith(suffix)


def present(name: str) -> Column:
    """FLT-11: the bin exists (is not null)."""
    return F.col(name).isNotNull()


def all_of(*preds: Column) -> Column:
    """FLT-12."""
    return reduce(lambda a, b: a & b, preds)


def any_of(*preds: Column) -> Column:
    """FLT-13."""
    return reduce(lambda a, b: a | b, preds)


def lines_without(name: str, marker: str) -> Column:
    """FLT-19: drop lines containing a marker (such as a header)."""
    return ~F.col(name).contains(marker)


def list_first(name: str) -> Column:
    """FN-10: first element of a list bin (null when empty)."""
    return F.try_element_at(F.col(name), F.lit(1))


def list_size(name: str) -> Column:
    return F.size(F.col(name))


def map_get_or(name: str, key: Any, default: Any) -> Column:
    """FN-11: ``map.getOrElse(key, default)``."""
    return F.coalesce(F.try_element_at(F.col(name), F.lit(key)), F.lit(default))


def map_has(name: str, key: Any) -> Column:
    """FN-11: ``map.contains(key)``."""
    return F.map_contains_key(F.col(name), F.lit(key))
