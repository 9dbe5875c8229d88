"""The stored layout of a record set: bucketed segments named by published manifests.

    <root>/_manifests/m-<version>.json
    <root>/_staging/<id of the write>/part-*.parquet          incoming rows of a write in progress
    <root>/data/w=<id of the write>/__bucket=<k>/part-*.parquet
    <root>/index/...                                          which segments hold a value, see ``sources.skipping``

Buckets are addressed by linear hashing: with n buckets and m the largest power of two up to n, a record lies in
``pmod(h, 2m)`` if that is below n and else in ``pmod(h, m)``, h = xxhash64(__digest). So a set grows by splitting
single buckets, and n is all a reader needs to know. With the average bucket held at ``BUCKET_BYTES`` no bucket is expected to be over twice that.

A bucket is a list of segments: a base, and after it deltas, which hold the newest whole form of the records they
name. A record's newest segment counts; ids of writes begin with the version they were made for, so they sort by age.
A manifest says, for one version of the set, how many buckets there are, the segments of each with their rows, bytes and
expiry times, the schema of the stored columns, the types of keys met, the indexed bins, and the last batch of each stream. All of these are fixed by the set, not by
the caller of a read or write.

A write puts its segments into a folder of its own and then publishes version n + 1 by the
exclusive creation of its manifest, so readers see either version whole. Of two writers that read
version n only one can publish; the other goes on from what is there now.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "__bucket"
WRITE = "w"
_MANIFEST = re.compile(r"m-(\d+)\.json")
# What a bucket should hold on average: by the optimizer's estimate for the first write, by the files' bytes afterwards.
BUCKET_BYTES = 128 << 20
MAX_BUCKETS = 65_536
# Taken when the optimizer has no estimate.
UNKNOWN_SIZE_BUCKETS = 64


class PublishConflict(Exception):
    """Another writer published this version first."""


@dataclass(frozen=True)
class Segment:
    write: str  # id of the write whose folder holds it
    rows: int = 0
    bytes: int = 0
    lasting: int = 0  # records that never expire
    first_expiry: int = 0  # least and greatest expiry of the others, 0 without any
    last_expiry: int = 0

    def dead(self, as_of: int) -> bool:
        return self.lasting == 0 and self.last_expiry <= as_of

    def has_expired(self, as_of: int) -> bool:
        return 0 < self.first_expiry <= as_of


@dataclass(frozen=True)
class Manifest:
    version: int
    buckets: int
    schema: str  # stored columns as Spark's JSON text
    segments: dict[int, tuple[Segment, ...]] = field(default_factory=dict)  # bucket -> base and deltas, by age
    key_tags: tuple[str, ...] = ()  # digest type tags of the keys met
    batches: dict[str, int] = field(default_factory=dict)  # stream -> last batch applied
    first_buckets: int = 0  # the count the set began with
    keyed_as: str = ""  # the set's name in all digests, empty when some record was not written by key under that name
    indexed: dict[str, str] = field(default_factory=dict)  # bin -> id of its index (``sources.skipping``)
    summaries: dict[str, str] = field(default_factory=dict)  # JSON bin -> id of the summary of the types in it

    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def folders(self) -> dict[int, str]:
        """The newest write of each bucket."""
        return {b: s[-1].write for b, s in self.segments.items()}

    @property
    def rows(self) -> int:
        return sum(s.rows for own in self.segments.values() for s in own)

    @property
    def bytes(self) -> int:
        return sum(s.bytes for own in self.segments.values() for s in own)

    def to_json(self) -> str:
        return json.dumps(asdict(self) | {"segments": {b: [list(asdict(s).values()) for s in own] for b, own in self.segments.items()}})

    @staticmethod
    def from_json(text: str) -> Manifest:
        d = json.loads(text)
        d["segments"] = {int(b): tuple(Segment(*s) for s in own) for b, own in d["segments"].items()}
        d["key_tags"] = tuple(d["key_tags"])
        return Manifest(**d)


def address(h: int, buckets: int) -> int:
    """The bucket of hash value ``h`` among ``buckets``."""
    m = 1 << (buckets.bit_length() - 1)
    return h % (2 * m) if h % (2 * m) < buckets else h % m


def bucket_of(digest: Column, buckets: int) -> Column:
    m = 1 << (buckets.bit_length() - 1)
    h = F.xxhash64(digest)
    wide = F.pmod(h, F.lit(2 * m))
    return F.when(wide < buckets, wide).otherwise(F.pmod(h, F.lit(m))).cast("int")


def split_parents(old: int, new: int) -> list[int]:
    """The buckets of ``old`` that lose records when the count grows to ``new``."""
    return sorted({address(b, old) for b in range(old, new)})


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def path_entries(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(name, time of last change in ms) of what matches the pattern."""
    p, fs = _path(spark, pattern)
    found = fs.globStatus(p)
    return [] if found is None else [(s.getPath().getName(), s.getModificationTime()) for s in found]


def _names(spark: SparkSession, pattern: str) -> list[str]:
    return [name for name, _ in path_entries(spark, pattern)]


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_manifests/m-{version:010d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, ascending."""
    found = (_MANIFEST.fullmatch(n) for n in _names(spark, f"{root.rstrip('/')}/_manifests/m-*.json"))
    return sorted(int(m.group(1)) for m in found if m)


def read_published(spark: SparkSession, root: str, version: int) -> str:
    """The text that was published as this version."""
    p, fs = _path(spark, _manifest_path(root, version))
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    return Manifest.from_json(read_published(spark, root, version))


def latest_version(spark: SparkSession, root: str) -> tuple[int, Manifest | None]:
    """(number, manifest) of the newest version; (0, None) when the set has none."""
    found = versions(spark, root)
    return (found[-1], read_manifest(spark, root, found[-1])) if found else (0, None)


def publish(spark: SparkSession, root: str, manifest) -> None:
    """Create the manifest's file, whole and only if its name is free; raise PublishConflict otherwise.

    The text goes to a file of its own first. The step that names it is atomic and refuses an
    existing name: a hard link on the local file system, a rename without overwrite elsewhere.
    """
    jvm = spark.sparkContext._jvm
    target = _manifest_path(root, manifest.version)
    temp = f"{root.rstrip('/')}/_manifests/.t-{uuid.uuid4().hex}"
    p, fs = _path(spark, temp)
    out = fs.create(p, False)
    out.write(bytearray(manifest.to_json().encode()))
    out.close()
    dest, _ = _path(spark, target)
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda x: jvm.java.io.File(fs.makeQualified(x).toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(dest), local(p))
        else:
            none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, dest, options)
    except Exception as e:  # noqa: BLE001 - py4j wraps the cause
        if "FileAlreadyExists" in str(e):
            raise PublishConflict(f"version {manifest.version} of {root} is taken") from None
        raise
    finally:
        fs.delete(p, False)


def read_buckets(spark: SparkSession, root: str, manifest: Manifest, buckets: list[int] | None = None, with_write: bool = False) -> DataFrame:
    """The stored records of the given buckets (all by default), with the bucket column, in the set's own schema.

    Of buckets with deltas the records of the base that a delta names are left out, and of several deltas the newest counts; filters and pruned
    columns still reach every file. ``with_write`` adds the id of the write that made the record's segment.
    """
    chosen = manifest.segments if buckets is None else {b: manifest.segments[b] for b in buckets if b in manifest.segments}
    schema = manifest.columns()
    stored = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
    out = (lambda df: df) if with_write else (lambda df: df.drop(WRITE))
    if not chosen:
        return out(spark.createDataFrame([], stored))
    data = f"{root.rstrip('/')}/data"

    def files(picked: list[tuple[int, Segment]]) -> DataFrame:
        return spark.read.schema(stored).option("basePath", data).parquet(*(f"{data}/w={s.write}/{BUCKET}={b}" for b, s in picked))

    whole = [(b, own[0]) for b, own in sorted(chosen.items()) if len(own) == 1]
    bases = [(b, own[0]) for b, own in sorted(chosen.items()) if len(own) > 1]
    deltas = [(b, s) for b, own in sorted(chosen.items()) for s in own[1:]]
    parts = [files(whole)] if whole else []
    if deltas:
        newest = files(deltas)
        if any(len(own) > 2 for own in chosen.values()):
            by_age = Window.partitionBy("__digest").orderBy(F.col(WRITE).desc())
            newest = newest.withColumn("__age", F.row_number().over(by_age)).where("__age = 1").drop("__age")
        parts += [files(bases).join(files(deltas).select("__digest"), "__digest", "left_anti").select(*stored.fieldNames()), newest]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return out(df)


def write_id(version: int) -> str:
    """An id for a write that goes on from ``version``; ids sort by it."""
    return f"{version + 1:010d}-{uuid.uuid4().hex}"


def write_segments(spark: SparkSession, root: str, records: DataFrame, buckets: int, write: str, indexed: dict[str, str] | None = None,
                   summaries: dict[str, str] | None = None) -> dict[int, Segment]:
    """Write records into the folder of ``write``, one file a bucket or, of a bucket too large for one task, several; index the ``indexed`` bins and sum up the types in the JSON bins of ``summaries``; the segments made."""
    folder = f"{root.rstrip('/')}/data/w={write}"
    keyed = records.withColumn(BUCKET, bucket_of(F.col("__digest"), buckets))
    # A task sorts its records by bucket. Of many records for few buckets (a first write larger than its estimate, a set that is yet to be split)
    # the rebalance deals those of one bucket to several tasks by their measured size, so that no task holds more at any size of the write.
    keyed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
    sizes: dict[int, int] = {}
    p, fs = _path(spark, folder)
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        if f.getPath().getName().endswith(".parquet"):
            b = int(f.getPath().getParent().getName().split("=", 1)[1])
            sizes[b] = sizes.get(b, 0) + f.getLen()
    if not sizes:
        return {}
    if indexed or summaries:
        from recordset.sources.skipping import write_index

        write_index(spark, root, indexed or {}, records.schema, write, summaries)
    expiry = F.col("__expiry")
    schema = T.StructType([T.StructField("__expiry", T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
    stats = spark.read.schema(schema).parquet(folder).groupBy(BUCKET).agg(
        F.count(F.lit(1)), F.sum((expiry == 0).cast("long")), F.min(F.when(expiry != 0, expiry)), F.max(F.when(expiry != 0, expiry)))
    return {b: Segment(write, rows, sizes[b], lasting, first or 0, last or 0) for b, rows, lasting, first, last in stats.collect()}


def choose_buckets(df: DataFrame) -> int:
    """Buckets for a new set, a power of two, from the optimizer's estimate of its first rows (no job runs)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 60:
        return UNKNOWN_SIZE_BUCKETS
    need = -(-size // BUCKET_BYTES)
    return min(1 << max(need - 1, 0).bit_length(), MAX_BUCKETS)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2, grace_sec: int = 86_400) -> list[str]:
    """Delete all but the newest ``keep`` manifests, and data, index and staging folders that no kept one names and that are older than ``grace_sec``.

    A write in progress has an unnamed folder, so the grace must exceed the longest write; readers of a dropped version
    fail, so ``keep`` must cover the longest read. Returns what was deleted.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    root = root.rstrip("/")
    found = versions(spark, root)
    gone = [_manifest_path(root, v) for v in found[:-keep]]
    named = {s.write for v in found[-keep:] for own in read_manifest(spark, root, v).segments.values() for s in own}
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    for folder in ("data/w=*", "_staging/*", "index/*/*/w=*"):
        p, fs = _path(spark, f"{root}/{folder}")
        for s in fs.globStatus(p) or []:
            if s.getPath().getName().removeprefix("w=") not in named and s.getModificationTime() <= now - grace_sec * 1000:
                inner = s.getPath().toUri().getPath().split("/")[-len(folder.split("/")):]
                gone.append(f"{root}/{'/'.join(inner)}")
    for path in gone:
        delete_path(spark, path)
    return gone
