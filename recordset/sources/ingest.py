"""Delimited text ingest (SRC-11, PRJ-4, FLT-19).

Lines are read with ``spark.read.text`` (file splits give the parallelism),
header lines are dropped by a marker, quotes are stripped, fields are split
on the separator and each field goes through its own Column parser. No
Python runs per line.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordset.functions.parse import field, split_fields

FieldSpec = tuple[str, Callable[[Column], Column]]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one ``value`` column per line."""
    return spark.read.text(path)


def ingest_delimited(
    lines: DataFrame,
    fields: Sequence[FieldSpec],
    header_marker: str | None = None,
    line_col: str = "value",
    sep: str = ",",
    keep_raw: bool = True,
) -> DataFrame:
    """Parse delimited lines into typed columns.

    ``fields`` lists (name, parser) in field order; a parser maps the raw
    field text to a typed Column. With ``keep_raw`` the raw texts are kept
    as ``<name>_text`` for derived columns (keys, times).
    """
    body = lines if header_marker is None else lines.where(~F.col(line_col).contains(header_marker))
    parts = body.select(split_fields(line_col, sep).alias("__f"))
    raw = parts.select(*[field(F.col("__f"), i + 1).alias(f"{name}_text") for i, (name, _) in enumerate(fields)])
    typed = [parse(F.col(f"{name}_text")).alias(name) for name, parse in fields]
    return raw.select(*typed, *([F.col(f"{n}_text") for n, _ in fields] if keep_raw else []))
