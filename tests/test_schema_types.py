"""SRC-6, SRC-7, SNK-14, FN-14: inference, typed bins, storage types, map to record."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.functions.types import map_to_struct, normalise_types, storage_type
from recordset.sources.schema import infer_bin_types, infer_schema, typed_bins


def docs(spark):
    return spark.createDataFrame(
        [(1, '{"a": 1, "b": "x", "l": [], "m": {"p": 1}}'),
         (2, '{"a": 2.5, "l": [3], "c": true, "m": {"q": 2}}'),
         (3, '{"s": "t", "z": 1}'),
         (4, '{"s": 5}')],
        "id int, j string",
    )


def test_inference_rules(spark):
    got = {r.bin: r.type for r in infer_bin_types(docs(spark), "j", sample=None).collect()}
    assert got["a"] == "DOUBLE"          # BIGINT + DECIMAL widen
    assert got["b"] == "STRING"
    assert got["l"] == "ARRAY<BIGINT>"   # empty list typed from a later sample
    assert got["m"] == "MAP<STRING, BIGINT>"
    assert got["c"] == "STRING"          # booleans are stored as text
    assert got["s"] == "STRING"          # STRING + BIGINT conflict
    assert got["z"] == "BIGINT"


def test_nested_types(spark):
    rows = ['{"x": [{"a": 1}, {"b": 2.5}], "y": {"p": {"q": [1]}, "r": {}}, "e": [], "n": null, "odd name: <x>": {"k,": "v"}}']
    df = spark.createDataFrame([(r,) for r in rows], "j string")
    got = {r.bin: r.type for r in infer_bin_types(df, "j").collect()}
    assert got == {"x": "ARRAY<MAP<STRING, DOUBLE>>", "y": "MAP<STRING, MAP<STRING, ARRAY<BIGINT>>>", "e": "ARRAY<STRING>", "n": "STRING",
                   "odd name: <x>": "MAP<STRING, STRING>"}
    r = typed_bins(df, "j", infer_schema(df, "j")).first()
    assert r["x"] == [{"a": 1.0}, {"b": 2.5}] and r["y"] == {"p": {"q": [1]}, "r": {}} and r["odd name: <x>"] == {"k,": "v"}


def test_nothing_is_lost_after_a_hundred_records(spark):
    rows = [(f'{{"a": {i}, "b": true}}',) for i in range(100)] + [('{"a": "text", "z": 5}',)]
    df = spark.createDataFrame(rows, "j string")
    t = typed_bins(df, "j", infer_schema(df, "j"))
    last = t.where("z = 5").first()
    assert last["a"] == "text" and t.where("b = 'true'").count() == 100 and t.where("a is null").count() == 0
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):  # a named sample may miss a type, but not silently
        typed_bins(df, "j", T.StructType([T.StructField("a", T.LongType())])).collect()


def test_sample_limits_bins(spark):
    got = {r.bin for r in infer_bin_types(docs(spark), "j", sample=2, order_by="id").collect()}
    assert got == {"a", "b", "l", "m", "c"}
    schema = infer_schema(docs(spark), "j", sample=2, order_by="id")
    assert schema.names == sorted(schema.names)


def test_typed_bins_missing_is_null(spark):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("zz", T.StringType())])
    rows = {r.id: r for r in typed_bins(docs(spark), "j", schema, keep=["id"]).collect()}
    assert rows[1].a == 1.0 and rows[2].a == 2.5 and rows[3].a is None and rows[1].zz is None


def test_storage_types(spark):
    df = spark.createDataFrame(
        [(1, 2, 3.5, True, dt.date(1970, 1, 2), [1, 2], {"k": 1})],
        "s short, i int, f float, b boolean, d date, arr array<int>, m map<string,int>",
    )
    n = normalise_types(df)
    assert dict(n.dtypes) == {"s": "bigint", "i": "bigint", "f": "double", "b": "string", "d": "bigint",
                              "arr": "array<bigint>", "m": "map<string,bigint>"}
    r = n.first()
    assert r.d == 86_400_000 and r.b == "true" and r.arr == [1, 2]
    assert storage_type(T.DecimalType(10, 2)) == T.StringType()


def test_map_to_struct(spark):
    rec = T.StructType([T.StructField("t", T.StringType(), False), T.StructField("ott", T.StringType(), True)])
    df = spark.createDataFrame([({"t": "a", "ott": "b", "extra": "x"},), ({"t": "a"},), ({"ott": "b"},)],
                               "m map<string,string>")
    ok = df.where(F.map_contains_key("m", F.lit("t"))).select(map_to_struct("m", rec).alias("r")).select("r.*").collect()
    assert sorted((r.t, r.ott or "") for r in ok) == [("a", ""), ("a", "b")]
    with pytest.raises(Exception, match="missing required field t"):
        df.select(map_to_struct("m", rec).alias("r")).collect()


def test_unordered_sample_is_bounded(spark):
    got = {r.bin for r in infer_bin_types(docs(spark), "j", sample=1).collect()}
    all_bins = {r.bin for r in infer_bin_types(docs(spark), "j", sample=None).collect()}
    assert got and got <= all_bins and len(got) < len(all_bins)


def test_json_bins_of_a_scanned_set(spark, tmp_out):
    from recordset.sources.api import reader, writer

    df = spark.createDataFrame([("a", '{"x": 1, "y": [1]}'), ("b", '{"x": "t", "z": true}')], "k string, j string")
    writer(df).mode("append").set("js").key("k").option("namespace", tmp_out).save(as_of=0)
    v = reader(spark).option("namespace", tmp_out).load("js", as_of=0, json_bins="j")
    assert v.columns[5:] == ["k", "x", "y", "z"]
    assert sorted((r.k, r.x, r.y, r.z) for r in v.collect()) == [("a", "1", [1], None), ("b", "t", None, "true")]
    first = reader(spark).option("namespace", tmp_out).option("schemaScan", 1).load("js", as_of=0, json_bins="j")
    assert dict(first.dtypes)["x"] == "bigint"
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        first.collect()
