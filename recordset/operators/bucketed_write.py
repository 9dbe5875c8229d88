"""Keyed writes into a stored set: what a write stores grows with the write, not with the set.

A write

1. evaluates its incoming rows once, into a staging folder of its own; all that follows, another attempt included, reads
   them there, so a source that gives other rows when read again cannot mislead it;
2. finds the buckets its records fall in (their number bounds what reaches the driver) and merges these with the staged rows by the rules
   of ``keyed_write``;
3. stores the records it made as a delta of each bucket. As deltas gather they are folded by size tiers into larger ones, and into the base
   once they have ``FOLD_INTO_BASE`` of its rows; a base is written without the records that have expired;
4. publishes the next version. If another writer was first and left the buckets of this write alone, the same files are published
   after its version; else the staged rows are merged again with what is there now. No update is lost;
5. splits buckets, in a version of its own, when they have become too large on average (``grow``).

So an upsert of a few keys into a 100 TB set stores a few records, and a set begun with ten rows takes any number later.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.operators.keyed_write import WriteSpec, conflicts_raised, merge, merge_prepared, one_row_a_digest, prepare_incoming, stored_form
from recordset.sources import layout
from recordset.sources.layout import (
    BUCKET, WRITE, Manifest, PublishConflict, Segment, bucket_of, choose_buckets, delete_path, latest_version, path_exists, publish, read_buckets,
    split_parents, write_id, write_segments,
)
from recordset.sources.store import DIGEST, EXPIRY, GENERATION, KEY, STORED_META, digest, key_type_tag, scan_view

# Times a write whose buckets others changed meanwhile merges again.
ATTEMPTS = 20
# So many deltas of one size tier are folded into one; a tier holds so many times the rows of the one before.
TIER = 4
# Deltas of at least this share of the base's rows are folded into it.
FOLD_INTO_BASE = 0.5
# Beyond this ratio of stored to incoming records the stored ones are cut to the incoming keys before the merge.
FEW = 10
# Share of the wanted size that the average bucket may have.
FILL = 0.75
_NOTHING = "~"  # sorts behind all ids of writes


def _touched(rows: DataFrame, dig: Column, buckets: int) -> dict[int, int]:
    """Rows for each bucket that has any."""
    return {b: n for b, n in rows.groupBy(bucket_of(dig, buckets)).agg(F.count(F.lit(1))).collect() if b is not None}


def _with_nulls(t: T.DataType) -> T.DataType:
    """The type with nulls allowed inside of lists and maps: whether one write has any does not bind the next."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_with_nulls(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_with_nulls(t.keyType), _with_nulls(t.valueType), True)
    return t


def _stored_schema(merged: T.StructType, old: T.StructType | None) -> T.StructType:
    """The set's columns after a write; a bin keeps its type."""
    fields = {f.name: T.StructField(f.name, _with_nulls(f.dataType), True) for f in merged.fields}
    for f in old.fields if old else ():
        now = fields.setdefault(f.name, T.StructField(f.name, _with_nulls(f.dataType), True))
        if now.dataType != _with_nulls(f.dataType):
            raise ValueError(f"bin {f.name} is stored as {f.dataType.simpleString()}, not {now.dataType.simpleString()}")
    bins = sorted(n for n in fields if n not in STORED_META)
    return T.StructType([fields[n] for n in (*STORED_META, *bins)])


def _empty_target(spark: SparkSession, incoming: DataFrame, spec: WriteSpec) -> DataFrame:
    bins = [f for f in prepare_incoming(incoming, spec).schema.fields if not f.name.startswith("__")]
    meta = zip((KEY, DIGEST, EXPIRY, GENERATION), (T.StringType(), T.BinaryType(), T.IntegerType(), T.IntegerType()))
    return spark.createDataFrame([], T.StructType([*(T.StructField(n, t) for n, t in meta), *bins]))


def _has_parquet(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, root) and bool(layout._names(spark, f"{root.rstrip('/')}/*.parquet"))


def _live(as_of: int) -> Column:
    return (F.col(EXPIRY) == 0) | (F.col(EXPIRY) > F.lit(as_of))


def tier(rows: int) -> int:
    n = 0
    while rows >= TIER:
        rows //= TIER
        n += 1
    return n


def folded_from(own: tuple[Segment, ...], rows: int) -> int:
    """From which of a bucket's segments on a write of ``rows`` records folds them into its own; their number if none, 0 for the base as well.

    The newest deltas of the write's tier or below are folded when ``TIER - 1`` of them or more are there, and so on with what that makes.
    """
    if not own or sum(s.rows for s in own[1:]) + rows >= FOLD_INTO_BASE * own[0].rows:
        return 0
    at = len(own)
    while True:
        first = at
        while first > 1 and tier(own[first - 1].rows) <= tier(rows):
            first -= 1
        if at - first < TIER - 1:
            return at
        rows += sum(s.rows for s in own[first:at])
        at = first


def _schema_tags(manifest: Manifest | None, incoming: DataFrame, spec: WriteSpec, plain: bool) -> set[str]:
    tags = set(manifest.key_tags if manifest else ())
    if spec.key_col and spec.key_col not in (KEY, spec.meta_columns[0]):
        tags.add(key_type_tag(incoming.schema[spec.key_col].dataType))
    elif plain or not tags or spec.key_col:
        tags |= {"L", "S", "B"}  # addressed by digest, scanned, or taken over: any type may be there
    return tags


def _first_write(spark: SparkSession, incoming: DataFrame, root: str, spec: WriteSpec, buckets: int | None, index: tuple[str, ...],
                 json_bins: tuple[str, ...]) -> tuple[Manifest, str]:
    """Version 1, not yet published, of rows read once, or of a plain folder of stored records with them."""
    plain = _has_parquet(spark, root)
    if plain:
        target = spark.read.parquet(root)
        missing = [c for c in STORED_META if c not in target.columns]
        if missing:
            raise ValueError(f"{root} holds files that are no stored set: no column {missing}")
        target = target.drop(BUCKET)
    else:
        target = _empty_target(spark, incoming, spec)
    n = buckets or choose_buckets(target.select(KEY) if plain else incoming)
    merged = merge(target, incoming, spec)
    schema = _stored_schema(merged.schema, None)
    write = write_id(0)
    if unknown := sorted((set(index) | set(json_bins)) - set(schema.fieldNames())):
        raise ValueError(f"no bins {unknown} to index or sum up")
    indexed, summaries = ({b: uuid.uuid4().hex for b in bins} for bins in (index, json_bins))
    with conflicts_raised():
        made = write_segments(spark, root, merged.select(*schema.fieldNames()), n, write, indexed, summaries)
    tags = tuple(sorted(_schema_tags(None, incoming, spec, plain)))
    keyed_as = spec.set_name if spec.key_col and not plain else ""
    return Manifest(1, n, schema.json(), {b: (s,) for b, s in made.items()}, tags, {}, n, keyed_as, indexed, summaries), write


def _next_write(spark: SparkSession, staged: DataFrame, incoming: DataFrame, root: str, spec: WriteSpec, base: Manifest) -> tuple[Callable[[Manifest], Manifest], list[int], str]:
    """(how a manifest changes by this write, its buckets, its id) after merging the staged rows with the buckets of ``base``."""
    rows = _touched(staged, F.col(DIGEST), base.buckets)
    fold = {b: folded_from(base.segments.get(b, ()), n) for b, n in rows.items()}
    touched = sorted(rows)
    target = read_buckets(spark, root, base, touched, with_write=True).drop(BUCKET)
    stored = sum(s.rows for b in touched for s in base.segments.get(b, ()))
    if all(fold[b] == len(base.segments.get(b, ())) for b in touched) and sum(rows.values()) * FEW < stored:
        target = target.join(staged.select(DIGEST).distinct(), DIGEST, "left_semi")
    merged = merge_prepared(target, one_row_a_digest(staged, spec), spec, carry=(WRITE,))
    schema = _stored_schema(T.StructType([f for f in merged.schema.fields if f.name not in (WRITE, "__written")]), base.columns())
    # Of each bucket: the records written, those of the segments that are folded, and of a new base only the live ones.
    cut = {b: _NOTHING if fold[b] == len(own) and own else "" if fold[b] == 0 else own[fold[b]].write for b in touched for own in [base.segments.get(b, ())]}
    cuts = spark.createDataFrame([(b, c) for b, c in cut.items()], f"{BUCKET} int, __cut string")
    merged = merged.withColumn(BUCKET, bucket_of(F.col(DIGEST), base.buckets)).join(F.broadcast(cuts), BUCKET)
    kept = F.col("__written") | (F.col(WRITE) >= F.col("__cut")) & ((F.col("__cut") != "") | _live(spec.as_of))
    write = write_id(base.version)
    with conflicts_raised():
        made = write_segments(spark, root, merged.where(kept).select(*schema.fieldNames()), base.buckets, write, base.indexed, base.summaries)
    if stray := sorted(set(made) - set(touched)):
        raise RuntimeError(f"records of buckets {stray} appeared in a write of buckets {touched}")
    tags = _schema_tags(base, incoming, spec, False)

    def change(now: Manifest) -> Manifest:
        segments = dict(now.segments)
        for b in touched:
            own = segments.pop(b, ())[:fold[b]] + ((made[b],) if b in made else ())
            if own:
                segments[b] = own
        keyed_as = now.keyed_as if spec.key_col and spec.set_name == now.keyed_as else ""
        return replace(now, version=now.version + 1, schema=_stored_schema(schema, now.columns()).json(), segments=segments, key_tags=tuple(sorted(tags | set(now.key_tags))),
                       keyed_as=keyed_as)

    return change, touched, write


def _typed_nulls(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of nothing but nulls in the type that the set has for them."""
    known = {f.name: f.dataType for f in schema.fields}
    return rows.select(*(F.col(f"`{f.name}`").cast(known[f.name]).alias(f.name) if isinstance(f.dataType, T.NullType) and f.name in known else F.col(f"`{f.name}`")
                         for f in rows.schema.fields))


def _same_buckets(a: Manifest, b: Manifest, buckets: list[int]) -> bool:
    return a.buckets == b.buckets and all(a.segments.get(k) == b.segments.get(k) for k in buckets)


def _publish_after(spark: SparkSession, root: str, base: Manifest, change: Callable[[Manifest], Manifest], buckets: list[int], batch: tuple[str, int] | None = None) -> Manifest | None:
    """Publish ``change`` after the newest version as long as that has the buckets as ``base`` had them; None when it has not, or has the batch."""
    now = base
    while True:
        after = change(now)
        if batch:
            after = replace(after, batches={**after.batches, batch[0]: batch[1]})
        try:
            publish(spark, root, after)
            return after
        except PublishConflict:
            _, now = latest_version(spark, root)
            if not _same_buckets(base, now, buckets) or batch and now.batches.get(batch[0], -1) >= batch[1]:
                return None


def write_bucketed(
    spark: SparkSession,
    incoming: DataFrame,
    set_root: str,
    spec: WriteSpec,
    buckets: int | None = None,
    batch: tuple[str, int] | None = None,
    bucket_bytes: int | None = None,
    index: tuple[str, ...] = (),
    json_bins: tuple[str, ...] = (),
) -> DataFrame | None:
    """Merge ``incoming`` into the set at ``set_root`` and return the set as it then is.

    ``buckets`` is the count a new set begins with; a different number later raises. ``bucket_bytes`` is the average size that buckets are split beyond. ``index`` names bins that a new set indexes (``sources.skipping``; later ones by ``index_bins``), ``json_bins`` JSON bins of which it keeps the types met. A plain parquet folder of stored
    records found at ``set_root`` is taken into the new layout with all its records. ``batch`` (stream, number)
    is published with the version; a batch that a version already has is skipped, and None is returned.
    """
    root = set_root.rstrip("/")
    staging, staged = f"{root}/_staging/{uuid.uuid4().hex}", None
    try:
        for _ in range(ATTEMPTS):
            version, manifest = latest_version(spark, root)
            if manifest and batch and manifest.batches.get(batch[0], -1) >= batch[1]:
                return None
            if manifest and buckets and buckets != manifest.first_buckets:
                raise ValueError(f"{set_root} was begun with {manifest.first_buckets} buckets, not {buckets}")
            if manifest is None and staged is None:
                first, write = _first_write(spark, incoming, root, spec, buckets, index, json_bins)
                try:
                    publish(spark, root, replace(first, batches={batch[0]: batch[1]} if batch else {}))
                    done = first
                    break
                except PublishConflict:
                    # What was stored of the rows goes; they are read whole once more, into staging.
                    delete_path(spark, f"{root}/data/w={write}")
                    continue
            if staged is None:
                _typed_nulls(stored_form(incoming, spec), manifest.columns()).write.parquet(staging)
                staged = spark.read.parquet(staging)
            change, touched, write = _next_write(spark, staged, incoming, root, spec, manifest)
            done = _publish_after(spark, root, manifest, change, touched, batch)
            if done is not None:
                break
            delete_path(spark, f"{root}/data/w={write}")
        else:
            raise PublishConflict(f"gave up writing to {set_root}: its buckets were changed by others {ATTEMPTS} times")
    finally:
        if staged is not None:
            delete_path(spark, staging)
    now = grow(spark, root, spec.as_of, bucket_bytes) or done
    return read_buckets(spark, root, now)


def grow(spark: SparkSession, set_root: str, as_of: int = 0, bucket_bytes: int | None = None) -> Manifest | None:
    """Split buckets until the average one holds at most ``FILL`` of ``bucket_bytes``, in one version; None when there was nothing to do.

    A bucket not yet split has less than twice the average. Only the buckets that are split are read and written, without records expired by ``as_of``.
    """
    root, limit = set_root.rstrip("/"), bucket_bytes or layout.BUCKET_BYTES
    for _ in range(ATTEMPTS):
        _, base = latest_version(spark, root)
        need = min(math.ceil(base.bytes / (FILL * limit)), layout.MAX_BUCKETS) if base else 0
        if base is None or need <= base.buckets:
            return None
        parents = split_parents(base.buckets, need)
        after = _rewritten(spark, root, base, parents, need, as_of)
        done = _publish_after(spark, root, base, after[0], parents)
        if done is not None:
            return done
        delete_path(spark, f"{root}/data/w={after[1]}")
    return None  # busy with writers; the next write tries again


def _rewritten(spark: SparkSession, root: str, base: Manifest, buckets: list[int], count: int, as_of: int) -> tuple[Callable[[Manifest], Manifest], str]:
    """(how a manifest changes, id of the write) when the given buckets are written anew as bases among ``count`` buckets."""
    write, made = write_id(base.version), {}
    there = [b for b in buckets if b in base.segments]
    if there:
        records = read_buckets(spark, root, base, there).drop(BUCKET).where(_live(as_of))
        made = write_segments(spark, root, records, count, write, base.indexed, base.summaries)

    def change(now: Manifest) -> Manifest:
        left = {b: own for b, own in now.segments.items() if b not in set(buckets)}
        return replace(now, version=now.version + 1, buckets=count, segments=left | {b: (s,) for b, s in made.items()})

    return change, write


def compact(spark: SparkSession, set_root: str, as_of: int) -> Manifest | None:
    """Fold all deltas into their bases and drop the records expired by ``as_of``; None when there was nothing to do.

    A bucket whose records have all expired is dropped without being read, by the expiry times in the manifest; one with neither deltas nor
    expired records is not opened.
    """
    root = set_root.rstrip("/")
    for _ in range(ATTEMPTS):
        _, base = latest_version(spark, root)
        if base is None:
            return None
        dead = [b for b, own in base.segments.items() if all(s.dead(as_of) for s in own)]
        mixed = [b for b, own in base.segments.items() if b not in set(dead) and (len(own) > 1 or own[0].has_expired(as_of))]
        if not dead and not mixed:
            return None
        change, write = _rewritten(spark, root, base, mixed, base.buckets, as_of)

        def without_dead(now: Manifest, change=change, dead=frozenset(dead)) -> Manifest:
            after = change(now)
            return replace(after, segments={b: own for b, own in after.segments.items() if b not in dead})

        done = _publish_after(spark, root, base, without_dead, dead + mixed)
        if done is not None:
            return done
        delete_path(spark, f"{root}/data/w={write}")
    return None


def bucket_cut(
    spark: SparkSession,
    set_root: str,
    ds: DataFrame,
    key_col: str,
    set_name: str,
    *,
    as_of: int,
    live_only: bool = True,
) -> DataFrame:
    """The records of a stored set that can match the keys of ``ds``.

    Only the buckets of the dataset's keys, with the type they have there, are read: their ids
    (at most as many as the set has buckets) are computed in one job, so a lookup of a few keys
    reads a few buckets. The result is a normal set view, to pass as the
    target of ``lookup_map`` / ``lookup_typed`` / ``lookup_wide`` / ``intersect_match``.
    """
    _, manifest = latest_version(spark, set_root)
    if manifest is None:
        raise ValueError(f"{set_root} has no published version")
    rows = ds.where(F.col(key_col).isNotNull()).select(digest(set_name, key_col, ds.schema[key_col].dataType).alias("d"))
    stored = read_buckets(spark, set_root, manifest, sorted(_touched(rows, F.col("d"), manifest.buckets)))
    return scan_view(stored, as_of, live_only=live_only, set_name=set_name)
