"""Chained reader / writer entry points (SRC-2, SNK-2).

    sets.reader(spark).option("namespace", root).set("dv").load(as_of=t)
    sets.writer(df).mode("append").set("dv").key("id").option("namespace", root).save(as_of=t)

Option names are checked when set (case-insensitive, unknown names raise);
values are validated when the options are resolved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordset.options import _canonical
from recordset.sources.skipping import Filter


class SetReader:
    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._opts: dict[str, object] = {}

    def option(self, name: str, value) -> SetReader:
        self._opts[_canonical(name)] = value
        return self

    def options(self, **opts) -> SetReader:
        for k, v in opts.items():
            self.option(k, v)
        return self

    def set(self, name: str) -> SetReader:
        return self.option("set", name)

    def load(self, set_name: str | None = None, *, as_of: int, key_col: str | None = None, live_only: bool = True,
             json_bins: str | None = None, where: Filter | None = None) -> DataFrame:
        from recordset.sources.store import scan_set

        opts = dict(self._opts)
        if set_name is not None:
            opts["set"] = set_name
        return scan_set(self._spark, as_of=as_of, key_col=key_col, live_only=live_only, json_bins=json_bins, where=where, **opts)


class SetWriter:
    def __init__(self, df: DataFrame):
        self._df = df
        self._mode: str | None = None
        self._opts: dict[str, object] = {}

    def mode(self, mode: str) -> SetWriter:
        self._mode = mode.lower()
        return self

    def option(self, name: str, value) -> SetWriter:
        self._opts[_canonical(name)] = value
        return self

    def options(self, **opts) -> SetWriter:
        for k, v in opts.items():
            self.option(k, v)
        return self

    def set(self, name: str) -> SetWriter:
        return self.option("set", name)

    def key(self, column: str) -> SetWriter:
        return self.option("updateByKey", column)

    def digest(self, column: str) -> SetWriter:
        return self.option("updateByDigest", column)

    def save(self, set_name: str | None = None, key: str | None = None, *, as_of: int) -> DataFrame:
        from recordset.operators.keyed_write import write_set

        opts = dict(self._opts)
        name = set_name or opts.pop("set", None)
        if name is None:
            raise ValueError("option 'set' is required")
        opts.pop("set", None)
        if key is not None:
            opts["updateByKey"] = key
        return write_set(self._df.sparkSession, self._df, name, as_of=as_of, mode=self._mode, **opts)


def reader(spark: SparkSession) -> SetReader:
    return SetReader(spark)


def writer(df: DataFrame) -> SetWriter:
    return SetWriter(df)
