"""Record sets on files (SRC-1..5, SRC-8, SRC-9, FN-12, FN-13).

A stored set is a folder in the layout of ``sources.layout``, or a plain parquet
folder of the same columns. Its columns are the record metadata
``__key`` STRING, ``__digest`` BINARY, ``__expiry`` INT (seconds, 0 =
never), ``__generation`` INT, followed by the bins. ``__ttl`` is not stored:
it is computed at scan time against an explicit ``as_of`` (never ``now()``,
so results are reproducible).

A plain table (no metadata columns) can be viewed as a set by naming its key
column; it then gets generation 1 and no expiry.

Column pruning and filter pushdown are left to Catalyst: every function
here returns a lazy DataFrame over ``spark.read.parquet``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.functions.timefn import ttl_from_expiry
from recordset.options import Options, resolve
from recordset.sources.layout import BUCKET, latest_version, read_buckets
from recordset.sources.schema import infer_schema, typed_bins
from recordset.sources.skipping import Filter, cut, json_schema

KEY, DIGEST, EXPIRY, GENERATION, TTL = "__key", "__digest", "__expiry", "__generation", "__ttl"
STORED_META = (KEY, DIGEST, EXPIRY, GENERATION)
META = STORED_META + (TTL,)
# Metadata entry of the digest column: the name of the set.
SET = "set"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_type_tag(dt: T.DataType) -> str:
    """Digest type tag: L for integral keys, S for strings, B for binary."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "L"
    if isinstance(dt, T.BinaryType):
        return "B"
    return "S"


def digest(set_name: str, key: Column | str, key_type: T.DataType) -> Column:
    """FN-13: 20-byte record digest, sha1 of ``set:tag:key``.

    A choice of ours (the store hashes internally); it is stable and keyed by
    set, so equal keys of different sets never collide.
    """
    k = _c(key)
    kstr = F.hex(k) if isinstance(key_type, T.BinaryType) else k.cast("string")
    return tagged_digest(set_name, key_type_tag(key_type), kstr)


def tagged_digest(set_name: str, tag: str, key_text: Column) -> Column:
    """The digest of a key given as text (hexadecimal for binary keys) and its type tag; null for a null key."""
    text = F.concat_ws(":", F.lit(set_name), F.lit(tag), key_text)
    return F.when(key_text.isNotNull(), F.unhex(F.sha1(text)))


def as_set(
    df: DataFrame,
    set_name: str,
    key_col: str,
    generation: Column | None = None,
    expiry: Column | None = None,
) -> DataFrame:
    """View a plain table as a stored set keyed by ``key_col``.

    The key column stays a bin too (SNK-8). ``generation`` and ``expiry``
    default to 1 and 0 (never expires).
    """
    kt = df.schema[key_col].dataType
    bins = sorted(c for c in df.columns if c not in META)
    return df.select(
        F.col(key_col).cast("string").alias(KEY),
        digest(set_name, key_col, kt).alias(DIGEST, metadata={SET: set_name}),
        (expiry if expiry is not None else F.lit(0)).cast("int").alias(EXPIRY),
        (generation if generation is not None else F.lit(1)).cast("int").alias(GENERATION),
        *bins,
    )


def scan_view(stored: DataFrame, as_of: int, options: Options | None = None, live_only: bool = False, set_name: str | None = None) -> DataFrame:
    """SRC-3/4/5: add ``__ttl``, optionally keep live records only, apply column renames.

    Bins come out sorted by name after the five metadata columns. The digest column's metadata names the set, so that lookups in the view can
    tell keys of different types apart.
    """
    opts = options or resolve()
    df = stored
    if live_only:
        df = live_records(df, as_of)
    bins = sorted(c for c in df.columns if c not in META and c != BUCKET)
    renames = dict(zip(META, opts.meta_columns))
    name = set_name or set_of(stored)
    return df.select(
        *[F.col(m).alias(renames[m], metadata={SET: name}) if m == DIGEST and name else F.col(m).alias(renames[m]) for m in STORED_META],
        ttl_from_expiry(EXPIRY, as_of).alias(renames[TTL]),
        *bins,
    )


def set_of(view: DataFrame) -> str | None:
    """The set a view was made of, by its digest column."""
    return next((f.metadata[SET] for f in view.schema.fields if f.name == DIGEST and SET in (f.metadata or {})), None)


def live_records(stored: DataFrame, as_of: int) -> DataFrame:
    """SRC-5: only records that have not expired by ``as_of`` (0 = never expires)."""
    return stored.where((F.col(EXPIRY) == 0) | (F.col(EXPIRY) > F.lit(as_of)))


def read_stored(spark: SparkSession, path: str, where: Filter | None = None) -> DataFrame:
    """A stored set: the newest published version, or the plain folder when nothing was published.

    Under a filter only the segments are opened that can hold a match; the filter itself is still to be applied.
    """
    _, manifest = latest_version(spark, path)
    if manifest is None:
        return spark.read.parquet(path)
    return read_buckets(spark, path, manifest if where is None else cut(spark, path, manifest, where))


def scan_set(
    spark: SparkSession,
    set_name: str | None = None,
    *,
    as_of: int,
    key_col: str | None = None,
    live_only: bool = True,
    json_bins: str | None = None,
    where: Filter | None = None,
    **options,
) -> DataFrame:
    """SRC-1/2: scan a whole set into a DataFrame with record metadata columns.

    ``json_bins`` names a column of JSON objects whose entries become typed bins in its place (SRC-6/7); their types
    come from all records, or from the first ``schemaScan`` by key when that option is set.

    ``where`` (made by ``sources.skipping.where``) keeps the records that meet it, and of a stored set opens only the files that can hold one:
    keys are found by their bucket, indexed bins by their index. It names bins, and metadata columns by their own or their new name.

    ``set_name`` (or option ``set``) is a folder, relative to option
    ``namespace`` when given. A plain table needs ``key_col``.
    """
    if set_name is not None:
        options["set"] = set_name
    opts = resolve(spark, **options)
    if where is not None:
        where = where.renamed(dict(zip(opts.meta_columns, META)))
    stored = read_stored(spark, opts.set_path(), where)
    if KEY not in stored.columns:
        if key_col is None:
            raise ValueError(f"{opts.set_path()} has no {KEY} column; pass key_col")
        stored = as_set(stored, set_label(opts.set), key_col)
    everything = stored
    if where is not None:
        stored = stored.where(where.column(stored))
        if json_bins is not None and KEY in everything.columns:
            everything = read_stored(spark, opts.set_path())  # the types are those of all records, whatever the filter
            if KEY not in everything.columns:
                everything = as_set(everything, set_label(opts.set), key_col)
    view = scan_view(stored, as_of, opts, live_only=live_only, set_name=set_label(opts.set))
    if json_bins is None:
        return view
    _, manifest = latest_version(spark, opts.set_path())
    if manifest is not None and json_bins in manifest.summaries and not opts.schemaScan:
        schema = json_schema(spark, opts.set_path(), manifest, json_bins)
    else:
        schema = infer_schema(everything, json_bins, opts.schemaScan, KEY if opts.schemaScan else None)
    rest = [c for c in view.columns if c != json_bins]
    if clash := sorted(set(rest) & set(schema.fieldNames())):
        raise ValueError(f"{json_bins} has entries named like columns of the set: {clash}")
    return typed_bins(view, json_bins, schema, keep=rest)


def set_label(set_path: str) -> str:
    """The set's name: last path part without a file extension."""
    name = set_path.rstrip("/").rsplit("/", 1)[-1]
    return name.split(".", 1)[0]


def bin_columns(df: DataFrame, options: Options | None = None) -> list[str]:
    """SNK-13: data columns minus metadata columns, sorted by name."""
    opts = options or resolve()
    meta = set(opts.meta_columns) | set(META)
    return sorted(c for c in df.columns if c not in meta)


def bins_only(df: DataFrame, options: Options | None = None) -> DataFrame:
    return df.select(*bin_columns(df, options))


def digest_hex(c: Column | str) -> Column:
    """Binary digest as lowercase hex text, for reports and checks."""
    return F.lower(F.hex(_c(c)))
