"""SRC-2, SNK-2: chained reader and writer."""

import pytest

from recordset.sources import api

AS_OF = 100


def test_writer_then_reader(spark, tmp_out):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "a int, b string")
    api.writer(df).mode("Ignore").set("Data").key("a").option("NAMESPACE", tmp_out).save(as_of=AS_OF)
    v = api.reader(spark).option("namespace", tmp_out).set("Data").load(as_of=AS_OF)
    assert sorted(r["__key"] for r in v.collect()) == ["1", "2", "3"]
    again = spark.createDataFrame([(1, "z")], "a int, b string")
    api.writer(again).mode("append").options(namespace=tmp_out).save("Data", "a", as_of=AS_OF)
    got = {r["__key"]: r["b"] for r in api.reader(spark).options(namespace=tmp_out).load("Data", as_of=AS_OF).collect()}
    assert got == {"1": "z", "2": "b", "3": "c"}


def test_unknown_option_fails_early(spark):
    with pytest.raises(ValueError, match="unknown option"):
        api.reader(spark).option("seedhost", "h")
    with pytest.raises(ValueError):
        api.writer(spark.range(1)).save(as_of=0)  # no set


def test_bucketed_through_writer(spark, tmp_out):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "a int, b string")
    api.writer(df).mode("append").set("bk").key("a").option("namespace", tmp_out).option("buckets", "8").save(as_of=AS_OF)
    upd = spark.createDataFrame([(3, "new")], "a int, b string")
    api.writer(upd).mode("append").set("bk").key("a").options(namespace=tmp_out, buckets=8).save(as_of=AS_OF)
    got = {r["__key"]: (r["b"], r["__generation"]) for r in api.reader(spark).option("namespace", tmp_out).load("bk", as_of=AS_OF).collect()}
    assert len(got) == 50 and got["3"] == ("new", 2) and got["4"] == ("v4", 1)
    with pytest.raises(ValueError):
        api.writer(upd).set("bk").key("a").option("buckets", "x").save(as_of=AS_OF)


def test_errorifexists_through_writer_leaves_set_unchanged(spark, tmp_out):
    from recordset.operators.keyed_write import WriteConflict
    from recordset.sources.layout import latest_version

    df = spark.createDataFrame([(1, "a"), (2, "b")], "a int, b string")
    api.writer(df).mode("errorifexists").set("c").key("a").option("namespace", tmp_out).save(as_of=AS_OF)
    clash = spark.createDataFrame([(2, "x"), (9, "y")], "a int, b string")
    with pytest.raises(WriteConflict):
        api.writer(clash).mode("errorifexists").set("c").key("a").option("namespace", tmp_out).save(as_of=AS_OF)
    assert latest_version(spark, f"{tmp_out}/c")[0] == 1
    got = {r["__key"]: r["b"] for r in api.reader(spark).option("namespace", tmp_out).load("c", as_of=AS_OF).collect()}
    assert got == {"1": "a", "2": "b"}
