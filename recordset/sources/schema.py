"""Schema of schemaless bins (SRC-6, SRC-7).

Records arrive as JSON objects (one per row). A bin is a top-level name.
Inference explodes every record into (bin, value) pairs and merges
the value types per bin with ``schema_of_variant_agg`` - an aggregation
with map-side partial merge, so it scales like any
group-by over the number of distinct bins. All records count unless the caller names a sample.

Our rules (differing on purpose from a last-record-wins map):
* integers -> BIGINT, decimals and floats -> DOUBLE, strings -> STRING;
* booleans -> STRING, as they are stored (SNK-14);
* conflicting types widen (BIGINT + DOUBLE -> DOUBLE, otherwise STRING);
* lists -> ARRAY and objects -> MAP<STRING, ...> at any depth, their element and value types merged;
  a type that no record tells (always null, always empty) is STRING;
* bins come out sorted by name; a value that does not fit its bin's type raises when it is read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\s*(`(?:[^`]|``)*`|[<>:,]|[^<>:,\s`()]+(?:\([^)]*\))?)")


def _parse(text: str):
    """A variant type as a tree: a scalar's name, ("ARRAY", type) or ("OBJECT", [types of its fields])."""
    tokens = _TOKEN.findall(text)
    at = 0

    def take() -> str:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def one():
        name = take().upper()
        if name not in ("ARRAY", "OBJECT") or at >= len(tokens) or tokens[at] != "<":
            return name if name != "OBJECT" else (name, [])
        take()
        if name == "ARRAY":
            inner = one()
            take()
            return name, inner
        fields = []
        while tokens[at] != ">":
            if tokens[at] == ",":
                take()
                continue
            take()  # the field's name
            take()  # the colon
            fields.append(one())
        take()
        return name, fields

    return one()


def _widen(a, b):
    """The storage type that holds both; None stands for a type nothing is known of."""
    if a is None or b is None or a == b:
        return a if b is None else b
    if {a, b} == {"BIGINT", "DOUBLE"}:
        return "DOUBLE"
    if isinstance(a, tuple) and isinstance(b, tuple) and a[0] == b[0]:
        return a[0], _widen(a[1], b[1])
    return "STRING"


def _storage(t):
    if isinstance(t, tuple):
        kind, inner = t
        if kind == "ARRAY":
            return kind, _storage(inner)
        value = None
        for x in inner:
            value = _widen(value, _storage(x))
        return "MAP", value
    if t == "VOID":
        return None
    if t in ("TINYINT", "SMALLINT", "INT", "BIGINT"):
        return "BIGINT"
    return "DOUBLE" if t.startswith("DECIMAL") or t in ("FLOAT", "DOUBLE") else "STRING"


def _ddl(t) -> str:
    if isinstance(t, tuple):
        return f"ARRAY<{_ddl(t[1])}>" if t[0] == "ARRAY" else f"MAP<STRING, {_ddl(t[1])}>"
    return t or "STRING"


def _sample(df: DataFrame, sample: int | None, order_by: str | None) -> DataFrame:
    if sample is None:
        return df
    # The sample is the feature (first n records); order makes it reproducible
    # (a top-k: each task keeps n rows).
    if order_by:
        return df.orderBy(order_by).limit(sample)
    # Unordered: a top-level limit is collected incrementally, touching only the
    # first partitions of a large set; the n records (the sample size, a small
    # bound) become a small DataFrame for the inference.
    rows = df.limit(sample).collect()
    return df.sparkSession.createDataFrame(rows, df.schema)


def type_summaries(df: DataFrame, json_col: str, by: str | None = None) -> DataFrame:
    """Rows (``by``, bin, t, inner_t): the merged variant types of each bin, and of the values inside of its objects."""
    spark = df.sparkSession
    own = [by] if by else []
    v = df.select(F.parse_json(F.col(json_col)).alias("__v"), *own)
    # Lateral table functions plan as Generate steps (no join, no shuffle).
    pairs = (
        v.lateralJoin(spark.tvf.variant_explode_outer(F.col("__v").outer()).toDF("pos", "bin", "value"))
        .where(F.col("bin").isNotNull())
        .select("bin", "value", *own)
    )
    # An object's fields are merged as values of one map, so a map of many keys has a short type.
    is_object = F.expr("schema_of_variant(value)").startswith("OBJECT")
    inner = pairs.withColumn("__obj", F.when(is_object, F.col("value"))).lateralJoin(
        spark.tvf.variant_explode_outer(F.col("__obj").outer()).toDF("ipos", "ikey", "ivalue")
    )
    return inner.groupBy(*own, "bin").agg(
        F.expr("schema_of_variant_agg(CASE WHEN __obj IS NULL THEN value ELSE parse_json('{}') END)").alias("t"),
        F.expr("schema_of_variant_agg(ivalue)").alias("inner_t"),
    )


def merged_types(summaries: DataFrame) -> dict[str, object]:
    """Storage type of each bin from any number of summaries: they merge like the records they stand for."""
    types: dict[str, object] = {}
    for r in summaries.select("bin", "t", "inner_t").distinct().collect():  # the different types met: the schema
        t = _parse(r["t"])
        if isinstance(t, tuple) and t[0] == "OBJECT":
            t = t[0], [_parse(r["inner_t"] or "VOID")]
        types[r["bin"]] = _widen(types.get(r["bin"]), _storage(t))
    return types


def _bin_types(df: DataFrame, json_col: str, sample: int | None, order_by: str | None) -> list[tuple[str, str]]:
    s = _sample(df.select(json_col, *([order_by] if order_by else [])), sample, order_by)
    return sorted((b, _ddl(t)) for b, t in merged_types(type_summaries(s, json_col)).items())


def infer_bin_types(df: DataFrame, json_col: str, sample: int | None = None, order_by: str | None = None) -> DataFrame:
    """Rows (bin, type) over all records, or over ``sample`` of them (the first by ``order_by``)."""
    return df.sparkSession.createDataFrame(_bin_types(df, json_col, sample, order_by), "bin string, type string")


def schema_of(types: dict[str, object]) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(_ddl(t)), True) for n, t in sorted(types.items())])


def infer_schema(df: DataFrame, json_col: str, sample: int | None = None, order_by: str | None = None) -> T.StructType:
    """SRC-6: the bins and their types as a StructType."""
    return T.StructType([T.StructField(n, T._parse_datatype_string(t), True) for n, t in _bin_types(df, json_col, sample, order_by)])


def typed_bins(df: DataFrame, json_col: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """SRC-7: one typed nullable column per bin; a missing bin is null, a value of another type raises."""
    v = F.parse_json(F.col(json_col))
    cols = [F.variant_get(v, "$['" + f.name.replace("'", "\\'") + "']", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return df.select(*(keep or []), *cols)
