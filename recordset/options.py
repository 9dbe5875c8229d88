"""Reader/writer options (SRC-2, SNK-2, SNK-10, SNK-16).

Names are case-insensitive; unknown ``recordset.*`` names are rejected.
An explicit option beats the session conf (``spark.conf`` key
``recordset.<name>``), which beats the default.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

PREFIX = "recordset."

SAVE_MODES = ("errorifexists", "ignore", "overwrite", "append", "update_only")
GENERATION_POLICIES = ("none", "expect_gen_equal")

# Defaults (the metadata names follow the reference).
DEFAULTS = {
    "namespace": None,
    "set": None,
    "schemaScan": None,  # records to infer JSON bins from; all when not given
    "keyColumn": "__key",
    "digestColumn": "__digest",
    "expiryColumn": "__expiry",
    "generationColumn": "__generation",
    "ttlColumn": "__ttl",
    "updateByKey": None,
    "updateByDigest": None,
    "saveMode": "ignore",
    "generationPolicy": "none",
    "buckets": None,  # of a new set; chosen by size when not given
    "indexBins": None,  # bins that a new set indexes, with commas between
    "jsonBins": None,  # JSON bins of which a new set keeps the types met, likewise
}
_COUNTS = ("schemaScan", "buckets")
_BY_LOWER = {k.lower(): k for k in DEFAULTS}


def _canonical(name: str) -> str:
    n = name[len(PREFIX):] if name.lower().startswith(PREFIX) else name
    key = _BY_LOWER.get(n.lower())
    if key is None:
        raise ValueError(f"unknown option {name!r}; known: {sorted(DEFAULTS)}")
    return key


@dataclass(frozen=True)
class Options:
    namespace: str | None
    set: str | None
    schemaScan: int | None
    keyColumn: str
    digestColumn: str
    expiryColumn: str
    generationColumn: str
    ttlColumn: str
    updateByKey: str | None
    updateByDigest: str | None
    saveMode: str
    generationPolicy: str
    buckets: int | None
    indexBins: str | None
    jsonBins: str | None

    @property
    def meta_columns(self) -> tuple[str, ...]:
        return (self.keyColumn, self.digestColumn, self.expiryColumn, self.generationColumn, self.ttlColumn)

    def set_path(self) -> str:
        if not self.set:
            raise ValueError("option 'set' is required")
        if self.namespace:
            return f"{self.namespace.rstrip('/')}/{self.set}"
        return self.set

    def names(self, option: str) -> tuple[str, ...]:
        return tuple(b.strip() for b in (getattr(self, option) or "").split(",") if b.strip())

    def write_key(self) -> tuple[str, str]:
        """SNK-10: exactly one of updateByKey / updateByDigest; returns (kind, column)."""
        if self.updateByKey and self.updateByDigest:
            raise ValueError("give updateByKey or updateByDigest, not both")
        if self.updateByKey:
            return "key", self.updateByKey
        if self.updateByDigest:
            return "digest", self.updateByDigest
        raise ValueError("a keyed write needs updateByKey or updateByDigest")


def resolve(spark: SparkSession | None = None, **opts) -> Options:
    """Merge explicit options over session conf over defaults, validating values."""
    values = dict(DEFAULTS)
    if spark is not None:
        for k in DEFAULTS:
            v = spark.conf.get(PREFIX + k, None)
            if v is not None:
                values[k] = v
    for name, v in opts.items():
        values[_canonical(name)] = v
    for k in _COUNTS:
        if values[k] is None:
            continue
        try:
            values[k] = int(values[k])
        except (TypeError, ValueError):
            raise ValueError(f"option {k} must be an integer, got {values[k]!r}") from None
        if values[k] <= 0:
            raise ValueError(f"option {k} must be positive")
    values["saveMode"] = str(values["saveMode"]).lower()
    if values["saveMode"] not in SAVE_MODES:
        raise ValueError(f"saveMode must be one of {SAVE_MODES}")
    values["generationPolicy"] = str(values["generationPolicy"]).lower()
    if values["generationPolicy"] not in GENERATION_POLICIES:
        raise ValueError(f"generationPolicy must be one of {GENERATION_POLICIES}")
    return Options(**{f.name: values[f.name] for f in fields(Options)})
