"""SRC-11, PRJ-4, FN-6..9: delimited lines with a header, empty values and 2400 times."""

from recordset.functions import parse as P
from recordset.sources.ingest import ingest_delimited, read_lines

LINES = [
    '"YEAR","CARRIER","FL_NUM","FL_DATE","DEP_TIME","DEP_DELAY_NEW"',
    '"2017","AA","100","2017-01-05","2400","12.5"',
    '"2017","DL","7","2017-01-05","","",',
    '"2017","UA","9","2017-01-06","0005","0"',
]
FIELDS = [("year", P.parse_int), ("carrier", lambda c: c), ("fl_num", lambda c: c), ("fl_date", lambda c: c),
          ("dep_time", lambda c: c), ("delay", P.parse_double_or_zero)]


def test_ingest_lines(spark, tmp_out):
    path = f"{tmp_out}/flights.csv"
    with open(path, "w") as f:
        f.write("\n".join(LINES) + "\n")
    df = ingest_delimited(read_lines(spark, path), FIELDS, header_marker="YEAR")
    out = df.select("year", "carrier", "delay", P.parse_time_ms("fl_date", "dep_time").alias("dep_ms"),
                    P.compose_key("carrier", "fl_num", "fl_date", "dep_time").alias("key")).orderBy("carrier")
    rows = [tuple(r) for r in out.collect()]
    day5 = 17171 * 86_400_000  # 2017-01-05
    assert rows[0] == (2017, "AA", 12.5, day5, "AA100:2017-01-05:2400")   # 2400 -> 0000 same date
    assert rows[1] == (2017, "DL", 0.0, None, "DL7:2017-01-05:XXXX")       # empty -> 0.0, null, XXXX
    assert rows[2] == (2017, "UA", 0.0, day5 + 86_400_000 + 5 * 60_000, "UA9:2017-01-06:0005")


def test_bad_numbers_are_null(spark):
    df = spark.createDataFrame([("x",), (" 12 ",)], "s string")
    assert [r[0] for r in df.select(P.parse_int("s")).collect()] == [None, 12]
