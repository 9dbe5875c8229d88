"""Keyed lookups against a set (JN-1..4, AGG-9).

The reference collects every key to the driver and fetches records in
batches of 500. Here a lookup is a distributed join:

1. the distinct keys of the dataset are computed with partial aggregation
   (a hot key collapses map-side, so skew does not reach the shuffle);
2. the set is cut to those keys with a left-semi join. AQE knows the exact size of the key list after its
   shuffle and broadcasts it when it is small; a caller that knows the dataset to be small
   passes ``small=True`` and the set is not shuffled at all.

No job runs while a plan is built. Set keys are unique within a key type, so the fetched
rows are at most a few per distinct key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.sources.store import DIGEST, KEY, META, digest, set_of


def _identity(ds: DataFrame, key_col: str, target: DataFrame) -> tuple[Column, str]:
    """(what a dataset row is looked up by, the target's column for it).

    A record is addressed by set, key type and key: the digest of the dataset's key, in its own type. A target that does not name its set (no view of
    ``scan_set``, ``scan_view`` or ``as_set``) is looked up by the key's text.
    """
    name = set_of(target)
    if name is not None:
        return digest(name, ds[key_col], ds.schema[key_col].dataType), DIGEST
    return ds[key_col].cast("string"), KEY


def fetch(ds: DataFrame, key_col: str, target: DataFrame, small: bool = False) -> DataFrame:
    """Records of ``target`` that the keys of ``ds`` address."""
    own, column = _identity(ds, key_col, target)
    keys = ds.select(own.alias("__lk")).where(F.col("__lk").isNotNull()).distinct()
    k = F.broadcast(keys) if small else keys
    return target.join(k, target[column] == k["__lk"], "left_semi")


def lookup_map(
    ds: DataFrame,
    key_col: str,
    target: DataFrame,
    bins: list[str] | None = None,
    small: bool = False,
) -> DataFrame:
    """JN-1: (key, bin, value) for each distinct dataset key found in the set.

    Misses vanish; null bins are dropped (an absent bin); values are strings,
    the common type of a key -> bin map. A found key without any requested
    bin stays as one row whose bin and value are null (an empty map).
    """
    found = fetch(ds, key_col, target, small)
    names = bins or [c for c in target.columns if c not in META]
    entries = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(b).cast("string").alias("value")) for b in names])
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    return found.select(F.col(KEY).alias("key"), F.explode_outer(present).alias("e")).select("key", "e.bin", "e.value")


def lookup_typed(
    ds: DataFrame,
    key_col: str,
    target: DataFrame,
    record: T.StructType,
    small: bool = False,
) -> DataFrame:
    """JN-2: found records as ``record`` fields plus ``__key``.

    A non-nullable field that the record lacks raises (FN-14 rules); a
    nullable one becomes null; bins not in ``record`` are ignored.
    """
    found = fetch(ds, key_col, target, small)
    return to_record(found, record).select(*[f.name for f in record.fields], F.col(KEY))


def to_record(df: DataFrame, record: T.StructType) -> DataFrame:
    """FN-14 on columns: project to ``record``; missing required values raise.

    The check is a filter, so it also runs when the field is not read afterwards.
    """
    cols, checks = [], []
    for f in record.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        v = src.cast(f.dataType)
        if not f.nullable:
            checks.append(F.when(v.isNull(), F.raise_error(F.lit(f"missing required field {f.name}")).cast("boolean")))
        cols.append(v.alias(f.name))
    if checks:
        df = df.where(F.coalesce(*checks, F.lit(True)))
    return df.select(*cols, *[c for c in df.columns if c in META])


def lookup_wide(
    ds: DataFrame,
    key_col: str,
    target: DataFrame,
    bins: list[str],
    small: bool = False,
) -> DataFrame:
    """JN-4: found records, one row per key, with the requested bins as columns."""
    found = fetch(ds, key_col, target, small)
    return found.select(F.col(KEY).alias("key"), *bins)


def intersect_match(
    ds: DataFrame,
    key_col: str,
    target: DataFrame,
    keep_unmatched: bool = True,
    small: bool = False,
) -> DataFrame:
    """JN-3: dataset rows whose record (same key) agrees on every present bin.

    A bin counts when it is non-null in the record; it must equal the
    dataset's same-named field. Rows whose key is not in the set are kept
    (an empty record matches) unless ``keep_unmatched`` is False. Dataset
    rows are never merged, so multiplicity is preserved.
    """
    bins = [c for c in target.columns if c not in META]
    missing = [b for b in bins if b not in ds.columns]
    if missing:
        raise ValueError(f"dataset has no field for bins {missing}")
    # Without a known small dataset one shuffle of each side on the key; a semi-join first would shuffle the set twice.
    found = fetch(ds, key_col, target, small=True) if small else target
    own, column = _identity(ds, key_col, target)
    r = found.select(F.col(column).alias("__rk"), *[F.col(b).alias(f"__r_{b}") for b in bins])
    j = ds.join(r, own == r["__rk"], "left")
    agree = F.lit(True)
    for b in bins:
        rb = F.col(f"__r_{b}")
        agree = agree & (rb.isNull() | F.coalesce(rb == ds[b], F.lit(False)))
    cond = F.col("__rk").isNull() & F.lit(keep_unmatched) | (F.col("__rk").isNotNull() & agree)
    return j.where(cond).select(*[ds[c] for c in ds.columns])
