"""Storage type rules (SNK-14) and map-to-record projection (FN-14).

Column types become the types a record can store:
  byte/short/int/long -> BIGINT; float/double -> DOUBLE; date -> BIGINT epoch
  millis of midnight UTC; string and binary unchanged; arrays and maps keep
  their shape with elements normalised; null stays null; anything else
  (boolean, decimal, timestamp, struct, interval...) -> its STRING form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.functions.timefn import DAY_MS


def storage_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, (T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dt, T.DateType):
        return T.LongType()
    if isinstance(dt, (T.StringType, T.BinaryType, T.NullType)):
        return dt
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(storage_type(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(storage_type(dt.keyType), storage_type(dt.valueType), True)
    return T.StringType()


def to_storage(c: Column, dt: T.DataType) -> Column:
    """Convert one value of type ``dt`` to its storage form (recursively)."""
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("bigint") * F.lit(DAY_MS)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: to_storage(x, dt.elementType))
    if isinstance(dt, T.MapType):
        m = F.transform_values(c, lambda _k, v: to_storage(v, dt.valueType))
        if storage_type(dt.keyType) != dt.keyType:
            m = F.transform_keys(m, lambda k, _v: to_storage(k, dt.keyType))
        return m
    target = storage_type(dt)
    return c if target == dt else c.cast(target)


def normalise_types(df: DataFrame) -> DataFrame:
    """SNK-14: every column in its storage type."""
    return df.select(*[to_storage(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def map_to_struct(m: Column | str, record: T.StructType) -> Column:
    """FN-14: a map column as a struct of ``record``'s fields.

    A missing entry for a non-nullable field raises; a nullable one is null;
    entries that are not fields are ignored.
    """
    m = F.col(m) if isinstance(m, str) else m
    fields = []
    for f in record.fields:
        v = F.try_element_at(m, F.lit(f.name)).cast(f.dataType)
        if not f.nullable:
            v = F.when(v.isNull(), F.raise_error(F.lit(f"map is missing required field {f.name}"))).otherwise(v)
        fields.append(v.alias(f.name))
    return F.struct(*fields)
