"""Which segments of a stored set a filter can match (SRC-1, SRC-9, FLT-1..9): keys by address, ranges by zones, values and items by postings.

    <root>/index/<id of the bin's index>/items/w=<id of the write>     item BIGINT (hash), buckets ARRAY<INT>, sorted by item
    <root>/index/<id of the bin's index>/zones/w=<id of the write>     __bucket INT, low, high
    <root>/index/<id of the bin's summary>/types/w=<id of the write>   __bucket INT, bin, t, inner_t: types met in a JSON bin (``sources.schema``)

A filter is made of ``where(name, op, value)`` with ``&`` and ``|``. It is rewritten to a set of segments, never to a set of records: the scan
applies the filter itself to what is read, so an index can only spare files.

* ``__key`` with ``=`` or ``in``: the buckets of the key's digests, one for each key type the set has met. Needs a set whose records were all
  written by key under one set name (``Manifest.keyed_as``).
* ``=``, ``in`` on an indexed bin (contained items of a list bin, keys of a map bin): the postings, read by pushed filter on the sorted hash.
* ``<``, ``<=``, ``>``, ``>=``, ``between``, ``prefix``, ``present`` on an indexed scalar bin: the least and greatest value of each segment.
* anything else, a bin without an index, or a value of another kind than the bin's: all segments.

The postings of one write have one row an item and in it at most one entry a bucket. Every write makes those of its own segments, from its
own files, so an upsert indexes what it stored. A segment whose write has no finished index (``_SUCCESS``) counts as a match; ``index_bins``
makes what is missing. Of a bucket the oldest matching segment and all newer ones are read, as the newer ones replace records of the older:
a filter that only deltas can match does not open the base.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.operators import predicates as P
from recordset.sources import layout
from recordset.sources.layout import BUCKET, WRITE, Manifest, Segment, bucket_of, latest_version
from recordset.sources.schema import merged_types, schema_of, type_summaries

_KEY, _DIGEST = "__key", "__digest"
_RANGES = ("<", "<=", ">", ">=", "between", "prefix", "present")
OPS = ("=", "in", "suffix", *_RANGES)
Found = set[tuple[str, int]] | None  # segments as (write, bucket); None for all
# Zones keep so many characters (bytes) of a text; a cut keeps the order, so cut ends compared with a cut value miss nothing.
ZONE_CHARS = 64
# Bins of one write that are indexed at the same time.
JOBS = 4


@dataclass(frozen=True)
class Filter:
    """A comparison of one bin, or several filters joined by ``and`` / ``or``."""

    op: str
    name: str = ""
    value: Any = None
    parts: tuple[Filter, ...] = ()

    def __and__(self, other: Filter) -> Filter:
        return Filter("and", parts=(self, other))

    def __or__(self, other: Filter) -> Filter:
        return Filter("or", parts=(self, other))

    def renamed(self, names: dict[str, str]) -> Filter:
        return replace(self, name=names.get(self.name, self.name), parts=tuple(p.renamed(names) for p in self.parts))

    def column(self, df: DataFrame) -> Column:
        """The filter as a predicate on the records (FLT-1..13)."""
        if self.parts:
            return (P.all_of if self.op == "and" else P.any_of)(*(p.column(df) for p in self.parts))
        equal = lambda v: P.bin_eq(df, self.name, str(v) if self.name == _KEY else v)  # noqa: E731 - keys are stored as text
        match self.op:
            case "=":
                return equal(self.value)
            case "in":
                return reduce(lambda a, b: a | b, map(equal, self.value), F.lit(False))
            case "between":
                return P.between(self.name, *self.value)
            case "prefix":
                return P.starts_with(self.name, self.value)
            case "suffix":
                return P.ends_with(self.name, self.value)
            case "present":
                return P.present(self.name)
        return P.compare(self.name, self.op, self.value)


def where(name: str, op: str, value: Any = None) -> Filter:
    """A filter on one bin or metadata column; on a list bin ``=`` means "contains", on a map bin "has the key"."""
    if op not in OPS:
        raise ValueError(f"unknown comparison {op!r}; known: {OPS}")
    if op == "in":
        value = tuple(value)
    if op == "between" and len(value) != 2:
        raise ValueError("between takes a pair (low, high)")
    return Filter(op, name, value)


def _item_type(t: T.DataType) -> T.DataType:
    return t.elementType if isinstance(t, T.ArrayType) else t.keyType if isinstance(t, T.MapType) else t


def _same_kind(t: T.DataType, value: Any) -> bool:
    """Whether Spark compares a bin of this type with the value in the bin's own order, without reading one as the other."""
    if isinstance(value, bool):
        return isinstance(t, T.BooleanType)
    if isinstance(t, T.IntegralType):
        return isinstance(value, int)
    if isinstance(t, T.DecimalType):
        return isinstance(value, (int, Decimal))
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return isinstance(value, float) or isinstance(value, int) and abs(value) <= 1 << 53
    if type(t) is T.StringType:
        return isinstance(value, str) and t == T.StringType()
    if isinstance(t, T.BinaryType):
        return isinstance(value, (bytes, bytearray))
    if isinstance(t, T.DateType):
        return isinstance(value, dt.date) and not isinstance(value, dt.datetime)
    return False


def _folder(root: str, index: str, part: str) -> str:
    return f"{root.rstrip('/')}/index/{index}/{part}"


def _scalar(t: T.DataType) -> bool:
    return isinstance(t, T.AtomicType)


def write_index(spark: SparkSession, root: str, indexed: dict[str, str], schema: T.StructType, write: str, summaries: dict[str, str] | None = None) -> None:
    """The index and the type summaries of the segments of one write, from its files; only the bins concerned are read, each by jobs of its own."""
    folder = f"{root.rstrip('/')}/data/w={write}"

    def one(name: str, index: str) -> None:
        kind = schema[name].dataType
        rows = spark.read.schema(T.StructType([schema[name], T.StructField(BUCKET, T.IntegerType())])).parquet(folder).withColumnRenamed(name, "v")
        if _scalar(kind):
            end = F.substring("v", 1, ZONE_CHARS) if isinstance(kind, (T.StringType, T.BinaryType)) else F.col("v")
            zones = rows.groupBy(BUCKET).agg(F.min(end).alias("low"), F.max(end).alias("high"))
            zones.write.mode("overwrite").parquet(f"{_folder(root, index, 'zones')}/{WRITE}={write}")
            items = rows
        else:
            items = rows.select(F.explode("v" if isinstance(kind, T.ArrayType) else F.map_keys("v")).alias("v"), BUCKET)
        items = items.where("v IS NOT NULL").groupBy(F.xxhash64("v").alias("item")).agg(F.sort_array(F.collect_set(BUCKET)).alias("buckets"))
        items = items.repartitionByRange("item").sortWithinPartitions("item")
        items.write.mode("overwrite").parquet(f"{_folder(root, index, 'items')}/{WRITE}={write}")

    def types(name: str, index: str) -> None:
        rows = spark.read.schema(T.StructType([schema[name], T.StructField(BUCKET, T.IntegerType())])).parquet(folder)
        type_summaries(rows, name, by=BUCKET).write.mode("overwrite").parquet(f"{_folder(root, index, 'types')}/{WRITE}={write}")

    todo = [(one, n, i) for n, i in sorted(indexed.items())] + [(types, n, i) for n, i in sorted((summaries or {}).items())]
    with ThreadPoolExecutor(JOBS) as pool:
        list(pool.map(lambda t: t[0](*t[1:]), [t for t in todo if t[1] in schema.fieldNames()]))


def json_schema(spark: SparkSession, root: str, manifest: Manifest, json_bin: str) -> T.StructType:
    """SRC-6 of a stored set: the bins inside of its JSON bin, as ``infer_schema`` over all stored records gives them.

    Of buckets without deltas the kept summaries are merged; only buckets whose deltas replace records of the base, whose types may then be gone, and
    those without a finished summary are opened.
    """
    index = manifest.summaries[json_bin]
    done = _finished(spark, root, index, "types")
    known = {b: own[0].write for b, own in manifest.segments.items() if len(own) == 1 and own[0].write in done}
    parts = []
    if known:
        base = _folder(root, index, "types")
        schema = f"{BUCKET} INT, bin STRING, t STRING, inner_t STRING, {WRITE} STRING"
        kept = spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{WRITE}={w}" for w in sorted(set(known.values()))))
        live = spark.createDataFrame([(w, b) for b, w in known.items()], f"{WRITE} string, {BUCKET} int")  # one row a bucket
        parts.append(kept.join(F.broadcast(live), [WRITE, BUCKET], "left_semi").select("bin", "t", "inner_t"))
    changed = sorted(set(manifest.segments) - set(known))
    if changed:
        parts.append(type_summaries(layout.read_buckets(spark, root, manifest, changed), json_bin))
    return schema_of(merged_types(reduce(DataFrame.unionByName, parts)) if parts else {})


def _finished(spark: SparkSession, root: str, index: str, part: str) -> set[str]:
    """The writes whose index is whole."""
    p, fs = layout._path(spark, f"{_folder(root, index, part)}/{WRITE}=*/_SUCCESS")
    return {s.getPath().getParent().getName().split("=", 1)[1] for s in fs.globStatus(p) or []}


def index_bins(spark: SparkSession, set_root: str, bins: Iterable[str]) -> Manifest:
    """Index bins of a stored set, now and at every later write; makes what is missing for those indexed already.

    The bins are published first, so of the writes under way each one either indexes its segments or is found here or at the next call. One job
    a write that still holds segments, reading the wanted bins only.
    """
    root = set_root.rstrip("/")
    while True:
        _, now = latest_version(spark, root)
        if now is None:
            raise ValueError(f"{set_root} has no published version")
        known = now.columns().fieldNames()
        if unknown := sorted(set(bins) - set(known)):
            raise ValueError(f"{set_root} has no bins {unknown}")
        new = {b: uuid.uuid4().hex for b in bins if b not in now.indexed}
        if not new:
            break
        now = replace(now, version=now.version + 1, indexed={**now.indexed, **new})
        try:
            layout.publish(spark, root, now)
            break
        except layout.PublishConflict:
            continue
    writes = {s.write for own in now.segments.values() for s in own}
    for name in bins:
        for write in sorted(writes - _finished(spark, root, now.indexed[name], "items")):
            write_index(spark, root, {name: now.indexed[name]}, now.columns(), write)
    return now


class _Lookup:
    def __init__(self, spark: SparkSession, root: str, manifest: Manifest):
        self.spark, self.root, self.manifest, self.schema = spark, root, manifest, manifest.columns()
        self.live = {(s.write, b) for b, own in manifest.segments.items() for s in own}

    def segments(self, f: Filter) -> Found:
        if f.parts:
            found = [self.segments(p) for p in f.parts]
            if f.op == "or":
                return None if any(s is None for s in found) else set.union(*found)
            known = [s for s in found if s is not None]
            return set.intersection(*known) if known else None
        if f.name == _KEY and f.op in ("=", "in") and self.manifest.keyed_as:
            return self._of_keys(f.value if f.op == "in" else (f.value,))
        if f.name not in self.manifest.indexed or f.name not in self.schema.fieldNames():
            return None
        kind = self.schema[f.name].dataType
        if f.op in ("=", "in"):
            return self._of_items(f.name, _item_type(kind), f.value if f.op == "in" else (f.value,))
        return self._in_zones(f, kind) if f.op in _RANGES and _scalar(kind) else None

    def _of_keys(self, keys: tuple) -> Found:
        if not all(isinstance(k, (str, int)) and not isinstance(k, bool) for k in keys):
            return None
        from recordset.sources.store import tagged_digest

        texts = self.spark.createDataFrame([(str(k),) for k in keys], "k string")
        n = self.manifest.buckets
        buckets = [bucket_of(tagged_digest(self.manifest.keyed_as, t, F.hex("k") if t == "B" else F.col("k")), n) for t in self.manifest.key_tags]
        wanted = {b for row in texts.select(F.array(*buckets)).collect() for b in row[0]}
        return {(w, b) for w, b in self.live if b in wanted}

    def _read(self, name: str, part: str, columns: list[T.StructField]) -> tuple[DataFrame | None, Found]:
        """(index rows of the live writes, segments without an index)."""
        base = _folder(self.root, self.manifest.indexed[name], part)
        done = _finished(self.spark, self.root, self.manifest.indexed[name], part)
        paths = [f"{base}/{WRITE}={w}" for w in sorted({w for w, _ in self.live} & done)]
        rows = None
        if paths:
            schema = T.StructType([*columns, T.StructField(WRITE, T.StringType())])
            rows = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return rows, {(w, b) for w, b in self.live if w not in done}

    def _of_items(self, name: str, kind: T.DataType, values: tuple) -> Found:
        if not all(_same_kind(kind, v) for v in values):
            return None
        rows, found = self._read(name, "items", [T.StructField("item", T.LongType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))])
        if rows is None or not values:
            return found
        # The hashes first, as plain numbers: they are then pushed into the scan of the sorted postings.
        typed = [F.lit(v).try_cast(kind) for v in values]
        row = self.spark.range(1).select(F.array(*(F.when(v.isNotNull(), F.xxhash64(v)) for v in typed))).first()[0]
        hashes = [h for h in row if h is not None]
        if hashes:
            hits = rows.where(F.col("item").isin(hashes)).select(WRITE, F.explode("buckets").alias(BUCKET)).distinct()
            found |= {(w, b) for w, b in hits.collect()} & self.live
        return found

    def _in_zones(self, f: Filter, kind: T.DataType) -> Found:
        values = f.value if f.op == "between" else () if f.op == "present" else (f.value,)
        if not all(_same_kind(kind, v) for v in values) or f.op == "prefix" and type(kind) is not T.StringType:
            return None
        low, high = F.col("low"), F.col("high")
        ends = [F.lit(v[:ZONE_CHARS] if isinstance(v, (str, bytes, bytearray)) else v) for v in values]
        match f.op:
            case "present":
                meets = high.isNotNull()
            case "between":
                meets = (high >= ends[0]) & (low <= ends[1])
            case "prefix":
                meets = (high >= ends[0]) & (F.substring(low, 1, min(len(f.value), ZONE_CHARS)) <= ends[0])
            case ">" | ">=":
                meets = high >= ends[0]
            case _:
                meets = low <= ends[0]
        rows, found = self._read(f.name, "zones", [T.StructField(BUCKET, T.IntegerType()), T.StructField("low", kind), T.StructField("high", kind)])
        if rows is not None:
            found |= {(w, b) for w, b in rows.where(meets).select(WRITE, BUCKET).collect()} & self.live
        return found


def cut(spark: SparkSession, root: str, manifest: Manifest, f: Filter) -> Manifest:
    """The manifest with the segments that a scan under the filter has to read. What reaches the driver is bounded by the set's segments."""
    found = _Lookup(spark, root, manifest).segments(f)
    if found is None:
        return manifest
    kept: dict[int, tuple[Segment, ...]] = {}
    for b, own in manifest.segments.items():
        first = next((i for i, s in enumerate(own) if (s.write, b) in found), None)
        if first is not None:
            kept[b] = own[first:]
    return replace(manifest, segments=kept)
