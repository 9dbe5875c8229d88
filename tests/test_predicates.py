"""FLT-1..14, FN-10, FN-11: list/map equality, residual predicates."""

from recordset.operators import predicates as P


def frame(spark):
    return spark.createDataFrame(
        [(1, [250, 251], {"index-1": 300}, "alpha"), (2, [], {}, "beta"), (3, None, None, None)],
        "k int, l array<bigint>, m map<string,bigint>, s string",
    )


def test_bin_eq_dispatch(spark):
    df = frame(spark)
    assert [r.k for r in df.where(P.bin_eq(df, "l", 251)).collect()] == [1]
    assert [r.k for r in df.where(P.bin_eq(df, "m", "index-1")).collect()] == [1]
    assert [r.k for r in df.where(P.bin_eq(df, "s", "beta")).collect()] == [2]


def test_comparisons_and_combinators(spark):
    df = frame(spark)
    assert df.where(P.compare("k", ">=", 2)).count() == 2
    assert df.where(P.compare("k", "<", 2)).count() == 1
    assert df.where(P.any_of(P.compare("k", "=", 1), P.all_of(P.present("s"), P.ends_with("s", "ta")))).count() == 2
    assert df.where(P.starts_with("s", "al")).count() == 1
    assert df.where(P.between("k", 1, 2)).count() == 2


def test_list_and_map_access(spark):
    df = frame(spark)
    got = {r.k: (r.first, r.n, r.v, r.has) for r in df.select(
        "k", P.list_first("l").alias("first"), P.list_size("l").alias("n"),
        P.map_get_or("m", "index-1", -1).alias("v"), P.map_has("m", "index-1").alias("has")).collect()}
    assert got[1] == (250, 2, 300, True)
    assert got[2][0] is None and got[2][2] == -1 and got[2][3] is False


def test_header_filter(spark):
    df = spark.createDataFrame([("YEAR,MONTH",), ("2017,1",)], "value string")
    assert df.where(P.lines_without("value", "YEAR")).count() == 1
