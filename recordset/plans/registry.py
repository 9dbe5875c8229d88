"""Named query catalogue: each entry is a Spark builder plus its DuckDB oracle SQL.

A builder takes ``(spark, sf_dir)`` and returns a DataFrame. The oracle is
ANSI SQL over the driver's pre-registered views, or ``None`` where the
operation is not expressible in SQL (then a unit test checks it against a
brute-force result instead).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    ops: tuple[str, ...]  # SURVEY §2 ids covered


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None, ops: tuple[str, ...] | str = ()):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, (ops,) if isinstance(ops, str) else tuple(ops))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from recordset.plans import (  # noqa: F401
        q_filters,
        q_ingest,
        q_lookup,
        q_report,
        q_report_state,
        q_roundtrip,
        q_scan,
        q_types,
        q_write,
    )

    return REGISTRY
