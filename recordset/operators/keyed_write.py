"""Keyed writes into a set with per-record save modes (SNK-1, SNK-3..17).

Modes act per record, as in the reference:

=============  ======================  =================
mode           key exists (and live)   key absent
=============  ======================  =================
errorifexists  the write fails         create
ignore         keep the old record     create
overwrite      replace all bins        create
append         merge bins (upsert)     create
update_only    merge bins              skip
=============  ======================  =================

With generation policy ``expect_gen_equal`` a row is written only when its
``__generation`` equals the stored one (an absent or expired record counts as
generation 0); otherwise its outcome is ``generation_conflict``.

Merging: a bin the incoming row carries replaces the stored one, a null
value included (it removes the bin); a bin it does not carry is kept.
Generation becomes 1 on create and stored + 1 on every other write. Expiry
is ``as_of + ttl`` when a TTL column is given (TTL -1 = never), else 0 on
create and unchanged on update.

Plan shape. The result is the whole new set, computed by one join on the
digest, which identifies a record (set, key type, key): ``target FULL OUTER
JOIN incoming``, one shuffle and one sort per side. A caller that knows the incoming rows to
be few passes ``small=True``: ``target LEFT JOIN broadcast(incoming)`` plus the incoming
rows the target lacks; the target is then never shuffled. No job runs while
the plan is built. Null keys and, unless ``order_by`` picks a row, keys repeated within one write fail the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordset.functions.types import to_storage
from recordset.options import GENERATION_POLICIES, SAVE_MODES
from recordset.sources.store import DIGEST, EXPIRY, GENERATION, KEY, META, STORED_META, TTL, digest, tagged_digest

OUTCOMES = (
    "created",
    "replaced",
    "updated",
    "skipped_exists",
    "skipped_missing",
    "generation_conflict",
    "exists_error",
)
UNTOUCHED = "untouched"


class WriteConflict(Exception):
    """A create-only write (errorifexists) met existing keys."""


@dataclass(frozen=True)
class WriteSpec:
    set_name: str
    mode: str = "ignore"
    key_col: str | None = None  # address by this column (SNK-8)
    digest_col: str | None = None  # or by this digest column (SNK-9)
    as_of: int = 0
    ttl_col: str | None = None  # SNK-12
    generation_col: str = GENERATION  # expected generation (SNK-11)
    generation_policy: str = "none"
    order_by: str | None = None  # resolves duplicate keys within one write
    meta_columns: tuple[str, ...] = META  # names the metadata columns go by in the incoming rows

    def __post_init__(self):
        if self.mode not in SAVE_MODES:
            raise ValueError(f"mode must be one of {SAVE_MODES}")
        if self.generation_policy not in GENERATION_POLICIES:
            raise ValueError(f"generation_policy must be one of {GENERATION_POLICIES}")
        if bool(self.key_col) == bool(self.digest_col):
            raise ValueError("give exactly one of key_col (updateByKey) or digest_col (updateByDigest)")


EXISTS_MESSAGE = "keys already exist in the set"


def _incoming_bins(incoming: DataFrame, spec: WriteSpec) -> list[str]:
    """SNK-13: written bins = incoming columns minus metadata (under either name).

    The key column stays a bin too, unless it is the metadata key column of a scan.
    """
    names = set(META) | set(spec.meta_columns)
    skip = names | ({spec.ttl_col, spec.generation_col, spec.digest_col, spec.order_by} - {spec.key_col, None})
    return sorted(c for c in incoming.columns if c not in skip)


def _scanned_digest(incoming: DataFrame, spec: WriteSpec) -> str | None:
    """The digest column beside a scan's own key column: it says which key type the text of the key stands for."""
    if spec.key_col not in (KEY, spec.meta_columns[0]):
        return None
    return next((c for c in (spec.meta_columns[1], DIGEST) if c in incoming.columns), None)


def prepare_incoming(incoming: DataFrame, spec: WriteSpec) -> DataFrame:
    """Incoming rows in stored form: __key, __digest, __in_gen, __in_expiry, __ok, bins (normalised); one row a digest.

    ``__ok`` is true; reading it fails on a null key and, without ``order_by``, on a repeated one.
    """
    return one_row_a_digest(stored_form(incoming, spec), spec)


def stored_form(incoming: DataFrame, spec: WriteSpec) -> DataFrame:
    """Incoming rows as __key, __digest, __in_gen, __in_expiry, __order (with ``order_by``) and bins, row by row."""
    bins = _incoming_bins(incoming, spec)
    if spec.key_col:
        kt = incoming.schema[spec.key_col].dataType
        key = F.col(spec.key_col).cast("string")
        dig = digest(spec.set_name, spec.key_col, kt)
        if own := _scanned_digest(incoming, spec):
            # A record of this set written back keeps its identity, integer and binary keys included, whose text the column holds.
            typed = [tagged_digest(spec.set_name, "L", key), tagged_digest(spec.set_name, "B", F.hex(key))]
            dig = F.coalesce(*(F.when(F.col(own) == t, t) for t in typed), dig)
    else:
        # By digest the key is not needed; a scanned frame still carries it.
        name = next((c for c in (spec.meta_columns[0], KEY) if c in incoming.columns), None)
        key = (F.col(name) if name else F.lit(None)).cast("string")
        dig = F.col(spec.digest_col).cast("binary")
    gen = F.col(spec.generation_col).cast("int") if spec.generation_col in incoming.columns else F.lit(None).cast("int")
    if spec.ttl_col:
        ttl = F.col(spec.ttl_col).cast("bigint")
        expiry = F.when(ttl == -1, F.lit(0)).when(ttl.isNull() | (ttl == 0), F.lit(None)).otherwise(F.lit(spec.as_of) + ttl)
    else:
        expiry = F.lit(None)
    extra = [F.col(spec.order_by).alias("__order")] if spec.order_by else []
    return incoming.select(
        key.alias(KEY),
        dig.alias(DIGEST),
        gen.alias("__in_gen"),
        expiry.cast("int").alias("__in_expiry"),
        *extra,
        *[to_storage(F.col(c), incoming.schema[c].dataType).alias(c) for c in bins],  # SNK-14
    )


def one_row_a_digest(pre: DataFrame, spec: WriteSpec) -> DataFrame:
    """Rows in stored form with ``__ok``, one for each digest."""
    no_key = F.when(F.col(DIGEST).isNull(), F.raise_error(F.lit("a keyed write needs a key in every row")))
    if spec.order_by is None:
        # The window has the shuffle and the sort that the join on the digest needs anyway.
        n = F.count(F.lit(1)).over(Window.partitionBy(DIGEST))
        twice = F.when(F.col("__n") > 1, F.raise_error(F.lit("incoming rows repeat a key; pass order_by to choose one")))
        return pre.withColumn("__n", n).withColumn("__ok", F.coalesce(no_key.cast("boolean"), twice.cast("boolean"), F.lit(True))).drop("__n")
    pick = F.min_by if spec.mode in ("errorifexists", "ignore") else F.max_by  # create-only: first wins
    cols = [c for c in pre.columns if c != DIGEST]
    # Ties on the order column are broken by a hash of the row, so a recomputed
    # stage (after a lost executor) picks the same row again.
    order = F.struct(F.col("__order"), F.xxhash64(*[F.col(c) for c in cols]))
    picked = pre.groupBy(DIGEST).agg(pick(F.struct(*cols), order).alias("__r"))
    return picked.select(DIGEST, *[F.col(f"__r.{c}").alias(c) for c in cols], F.coalesce(no_key.cast("boolean"), F.lit(True)).alias("__ok")).drop("__order")


def _join(target: DataFrame, inc: DataFrame, spec: WriteSpec, small: bool) -> tuple[DataFrame, list[str], list[str]]:
    """Target and incoming side by side, one row per key: __t_* and __i_* columns."""
    k = DIGEST
    t_cols = [c for c in target.columns if c != TTL]
    i_cols = [c for c in inc.columns if c != "__ok"]
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in t_cols], F.lit(True).alias("__t_present"))
    i = inc.select(*[F.col(c).alias(f"__i_{c}") for c in i_cols], F.col("__ok").alias("__i_present"))
    cond = t[f"__t_{k}"] == i[f"__i_{k}"]
    if small:
        bi = F.broadcast(i)
        left = t.join(bi, cond, "left")
        hit_keys = F.broadcast(t.select(F.col(f"__t_{k}").alias("__hk")).join(
            F.broadcast(i.select(F.col(f"__i_{k}").alias("__ik"))), F.col("__hk") == F.col("__ik"), "left_semi"
        ))
        only_i = i.join(hit_keys, i[f"__i_{k}"] == hit_keys["__hk"], "left_anti").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields], *i.columns
        )
        j = left.unionByName(only_i)
    else:
        j = t.join(i, cond, "full_outer")
    return j, t_cols, i_cols


def _outcome(spec: WriteSpec) -> Column:
    t_there = F.coalesce(F.col("__t_present"), F.lit(False))
    live = t_there & ((F.col(f"__t_{EXPIRY}") == 0) | (F.col(f"__t_{EXPIRY}") > F.lit(spec.as_of)))
    inc = F.coalesce(F.col("__i_present"), F.lit(False))
    stored_gen = F.when(live, F.col(f"__t_{GENERATION}")).otherwise(F.lit(0))
    exists = {
        "errorifexists": "exists_error",
        "ignore": "skipped_exists",
        "overwrite": "replaced",
        "append": "updated",
        "update_only": "updated",
    }[spec.mode]
    absent = "skipped_missing" if spec.mode == "update_only" else "created"
    o = F.when(~inc, F.lit(UNTOUCHED))
    if spec.generation_policy == "expect_gen_equal":
        o = o.when(~F.coalesce(F.col("__i___in_gen") == stored_gen, F.lit(False)), F.lit("generation_conflict"))
    return o.when(live, F.lit(exists)).otherwise(F.lit(absent))


def classify(target: DataFrame, incoming: DataFrame, spec: WriteSpec, small: bool = False) -> DataFrame:
    """SNK-17: (key, digest, outcome) for every incoming row."""
    inc = prepare_incoming(incoming, spec)
    j, _, _ = _join(target, inc, spec, small)
    return j.where(F.col("__i_present")).select(
        F.col(f"__i_{KEY}").alias(KEY), F.col(f"__i_{DIGEST}").alias(DIGEST), _outcome(spec).alias("outcome")
    )


def classify_many(
    target: DataFrame, incoming: DataFrame, specs: dict[str, WriteSpec], small: bool = False
) -> DataFrame:
    """SNK-17 for several modes at once: (label, key, digest, outcome) per incoming row and spec.

    The specs must address records the same way (key or digest column,
    order_by, TTL and generation columns); the key join is then done once and
    each spec only adds its outcome rule, instead of one join per mode.
    """
    first = next(iter(specs.values()))
    same = ("set_name", "key_col", "digest_col", "order_by", "ttl_col", "generation_col", "as_of")
    if any(getattr(sp, f) != getattr(first, f) for sp in specs.values() for f in same):
        raise ValueError("classify_many needs specs that differ only in mode and generation policy")
    inc = prepare_incoming(incoming, first)
    j, _, _ = _join(target, inc, first, small)
    outcomes = F.array(*[F.struct(F.lit(label).alias("label"), _outcome(sp).alias("outcome")) for label, sp in specs.items()])
    return (
        j.where(F.col("__i_present"))
        .select(F.col(f"__i_{KEY}").alias(KEY), F.col(f"__i_{DIGEST}").alias(DIGEST), F.explode(outcomes).alias("o"))
        .select("o.label", KEY, DIGEST, "o.outcome")
    )


def merge(target: DataFrame, incoming: DataFrame, spec: WriteSpec, small: bool = False) -> DataFrame:
    """The whole set after the write (stored form: key, digest, expiry, generation, bins).

    In mode errorifexists the job that reads the result fails when any key exists.
    """
    return merge_prepared(target, prepare_incoming(incoming, spec), spec, small)


def merge_prepared(target: DataFrame, inc: DataFrame, spec: WriteSpec, small: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``merge`` of rows that ``prepare_incoming`` made.

    With ``carry`` these columns of the target come along as they are (null for new records), and ``__written`` says whether the write made the row.
    """
    j, t_cols, i_cols = _join(target, inc, spec, small)
    j = j.withColumn("__outcome", _outcome(spec))
    if spec.mode == "errorifexists":
        conflict = F.when(F.col("__outcome") == "exists_error", F.raise_error(F.lit(EXISTS_MESSAGE)).cast("boolean"))
        j = j.where(F.coalesce(conflict, F.lit(True)))

    t_bins = [c for c in t_cols if c not in META and c not in carry]
    i_bins = [c for c in i_cols if c not in STORED_META and not c.startswith("__")]
    all_bins = sorted(set(t_bins) | set(i_bins))
    o = F.col("__outcome")
    keep_t = o.isin(UNTOUCHED, "skipped_exists", "skipped_missing", "generation_conflict")
    created = o == "created"
    replaced = o == "replaced"
    updated = o == "updated"

    def tcol(c):
        return F.col(f"__t_{c}") if c in t_cols else F.lit(None)

    def icol(c):
        return F.col(f"__i_{c}") if c in i_cols else F.lit(None)

    bins = []
    for b in all_bins:
        if b in i_bins:
            v = F.when(keep_t, tcol(b)).otherwise(icol(b))  # written bin, nulls included
        else:
            v = F.when(keep_t | updated, tcol(b)).otherwise(F.lit(None))  # replace/create drop it
        bins.append(v.alias(b))
    new_exp = icol("__in_expiry")
    expiry = (
        F.when(keep_t, tcol(EXPIRY))
        .when(created, F.coalesce(new_exp, F.lit(0)))
        .otherwise(F.coalesce(new_exp, tcol(EXPIRY)))
    )
    gen = F.when(keep_t, tcol(GENERATION)).when(created, F.lit(1)).otherwise(tcol(GENERATION) + 1)
    # Written rows, and target rows kept as they were; incoming rows that were
    # skipped and have no stored record leave nothing behind.
    return j.where(~keep_t | F.coalesce(F.col("__t_present"), F.lit(False))).select(
        F.when(keep_t, tcol(KEY)).otherwise(F.coalesce(icol(KEY), tcol(KEY))).alias(KEY),
        F.when(keep_t, tcol(DIGEST)).otherwise(icol(DIGEST)).alias(DIGEST),
        expiry.cast("int").alias(EXPIRY),
        gen.cast("int").alias(GENERATION),
        *bins,
        *([F.col(f"__t_{c}").alias(c) for c in carry] + [(~keep_t).alias("__written")] if carry else []),
    )


def conflicts(target: DataFrame, incoming: DataFrame, spec: WriteSpec) -> DataFrame:
    """SNK-3 probe: incoming keys that already exist (live) in the set."""
    probe = WriteSpec(**{**spec.__dict__, "mode": "errorifexists"})
    return classify(target, incoming, probe).where(F.col("outcome") == "exists_error")


def save_set(spark: SparkSession, target_path: str, incoming: DataFrame, out_path: str, spec: WriteSpec) -> DataFrame:
    """SNK-1: merge ``incoming`` into the set at ``target_path`` and write the new set to ``out_path``.

    The new version goes to a different folder (a reader sees the old or the
    new set, never a half-written one), and the returned DataFrame reads it
    back, so later steps start from the written table, not the lineage.
    """
    if out_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("write the new set to a new folder, not over the one being read")
    with conflicts_raised():
        merge(spark.read.parquet(target_path), incoming, spec).write.mode("errorifexists").parquet(out_path)
    return spark.read.parquet(out_path)


def write_set(
    spark: SparkSession,
    incoming: DataFrame,
    set_name: str,
    key_col: str | None = None,
    *,
    as_of: int,
    mode: str | None = None,
    order_by: str | None = None,
    **options,
) -> DataFrame:
    """SNK-2: save a DataFrame into a set by key (or digest), creating the set if needed.

    The set is the folder ``<namespace>/<set_name>``; see ``bucketed_write`` for
    what a write touches. ``mode`` defaults to the session's ``recordset.saveMode`` (SNK-16).
    Options are validated as for reads (updateByKey, updateByDigest, ttlColumn, generationPolicy, buckets, indexBins, jsonBins, ...).
    """
    from recordset.operators.bucketed_write import write_bucketed
    from recordset.options import resolve

    if key_col:
        options["updateByKey"] = key_col
    opts = resolve(spark, set=set_name, **options)
    kind, col = opts.write_key()
    spec = WriteSpec(
        set_name=set_name.rstrip("/").rsplit("/", 1)[-1],
        mode=(mode or opts.saveMode).lower(),
        key_col=col if kind == "key" else None,
        digest_col=col if kind == "digest" else None,
        as_of=as_of,
        ttl_col=opts.ttlColumn if opts.ttlColumn in incoming.columns else None,
        generation_col=opts.generationColumn,
        generation_policy=opts.generationPolicy,
        order_by=order_by,
        meta_columns=opts.meta_columns,
    )
    return write_bucketed(spark, incoming, opts.set_path(), spec, buckets=opts.buckets, index=opts.names("indexBins"), json_bins=opts.names("jsonBins"))


def save_by_class(spark: SparkSession, incoming: DataFrame, record_class: type, key_col: str, **kw) -> DataFrame:
    """SNK-2: save under the record class's simple name, as the set name."""
    return write_set(spark, incoming, record_class.__name__, key_col, **kw)


def default_mode(spark: SparkSession) -> str:
    """SNK-16: the session's default save mode, ``ignore`` when unset."""
    return str(spark.conf.get("recordset.saveMode", "ignore")).lower()


@contextmanager
def conflicts_raised() -> Iterator[None]:
    """Turn the failure of a create-only write's job into ``WriteConflict``."""
    try:
        yield
    except PySparkException as e:
        if EXISTS_MESSAGE in str(e):
            raise WriteConflict(EXISTS_MESSAGE) from e
        raise
