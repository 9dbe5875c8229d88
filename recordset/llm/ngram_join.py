"""N-gram Jaccard join by grouped prefixes.

A document is its set of distinct shingles (four words each in the query). Documents with equal sets
form a class, represented by its smallest id. Under one order of all shingles, two sets
with a Jaccard similarity of t or more share a shingle among the first
n - ceil(t * n) + 1 of each. The order puts shingles of many documents last (by counts taken over all documents), so that
common passages seldom stand in a prefix. Classes with the same prefix and the same size form a group, and
only groups are spread over their prefix shingles; a shingle's bucket matters if it has two groups. Then
groups are expanded, pairs whose prefixes differ too much are dropped, and the rest are verified on the whole sets.

Components need no pair whose ends are already connected. So each bucket first
compares its members with one hub; what is then left in buckets of
several components is compared pair by pair. A pair counts in a bucket only if the shingle stands early enough in both
orders for the sizes at hand. Members that link with
the hub cost the group's size, not its square; those of a large group that nearly but not quite link are compared with each other
where their order allows a link. No pair that could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm.components import connected_components, settled
from recordset.llm.frames import map_text
from recordset.llm.textvec import SPACE, U64, chunks, mix, sequence_hash, windows

SHINGLE = 4
# Two documents link when 100 * intersection >= PERCENT * union.
PERCENT = 85
# Slots of the table of shingle counts that orders the shingles: 16 MB at any input size.
COUNT_SLOTS = 1 << 22
# Shingles a counting task gathers before it hands on those it met twice.
TALLY_SHINGLES = 4_000_000
HUB_ROUNDS = 1
# Shingle sets, of some kilobytes each, that one task may well hold.
SETS_A_TASK = 20_000
# Slots of the bitmap of wanted ids: 1 MB at any input size.
SLOTS = 1 << 23


def shingle_sets(col: pa.Array, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer than k words is one shingle, one without words none."""
    for c in chunks(col, lower=True):
        s, e, first = c.words(SPACE)
        text, b, en = windows(first, k)
        h = sequence_hash(c.hash(s, e), b, en)
        cut = np.searchsorted(text, np.arange(c.n + 1))
        for i in range(c.n):
            yield np.unique(h[cut[i]:cut[i + 1]])


def shingle_counts(docs: DataFrame, text: str, slots: int, k: int = SHINGLE) -> np.ndarray:
    """How many documents hold the shingles of each slot, over all documents, as far as a task met a shingle twice.

    A task hands on the shingles it met twice; one that many documents hold is met so in many tasks, and the many that are
    met once do not blur the slots. The counts only order the shingles, so a low one costs time and loses nothing.
    """
    shift = 64 - (slots.bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def hand_on() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            twice = counts > 1
            slot, at = np.unique(slot_of(keys[twice], shift), return_inverse=True)
            return pa.record_batch([pa.array(slot), pa.array(np.bincount(at, weights=counts[twice], minlength=len(slot)).astype(np.int64))], names=["slot", "c"])

        for b in batches:
            for x in shingle_sets(b.column(0), k):
                parts.append(x)
                size += len(x)
                if size >= TALLY_SHINGLES:
                    yield hand_on()
                    parts, size = [], 0
        if parts:
            yield hand_on()

    counted = docs.select(text).mapInArrow(run, "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()
    table = np.zeros(slots, np.uint32)
    table[counted.column("slot").to_numpy()] = np.minimum(counted.column("c").to_numpy(), (1 << 32) - 1)
    return table


def slot_of(h: np.ndarray, shift: int) -> np.ndarray:
    return (h >> U64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(h), np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def in_order(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles, those of few documents first; the hash itself breaks ties."""
    return h[np.lexsort((h, counts[slot_of(h, 64 - (len(counts).bit_length() - 1))]))]


def _signed(x: np.ndarray) -> int:
    return int(np.array(x, U64).view(np.int64))


def prefixes(docs: DataFrame, text: str, counts: np.ndarray, percent: int, k: int = SHINGLE) -> DataFrame:
    """``docs`` with the set's size, its signature, and its prefix with a signature of prefix and size."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def make():
        counts = shared.value

        def describe(col: pa.Array) -> list:
            out: list[list] = [[] for _ in range(6)]
            for h in shingle_sets(col, k):
                n = len(h)
                prefix = in_order(h, counts)[:prefix_length(n, percent)] if n else h
                own = mix(np.append(prefix, U64(n)))
                values = (n, _signed(mix(h).sum()), _signed(mix(h ^ U64(0x5851F42D4C957F2D)).sum()), _signed(own.sum()), _signed(mix(own).sum()), prefix.view(np.int64))
                for o, v in zip(out, values):
                    o.append(v)
            return out

        return describe

    long = T.LongType()
    fields = [T.StructField(n, long) for n in ("n_shingles", "_s1", "_s2", "_g1", "_g2")] + [T.StructField("_prefix", T.ArrayType(long))]
    return map_text(docs, text, make, fields)


def _meet(n: str, pos: str, m: str, other: str, percent: int):
    """Whether sets of sizes n and m can be similar by what stands at these places of their order.

    The sizes must be near each other, and of the intersection that a link of these sizes needs, some shingle
    comes early enough in both orders that what stands before it may all be missing on the other side.
    """
    need = F.floor((percent * (F.col(n) + F.col(m)) + (99 + percent)) / (100 + percent))
    near = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return near & (F.col(pos) <= F.col(n) - need) & (F.col(other) <= F.col(m) - need)


def _possible(pairs: DataFrame, heads: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """The pairs whose prefixes leave a similarity of ``percent`` possible.

    Both prefixes follow one order, so a shingle of either that comes before the end of the other's prefix and is
    not in it is missing from the other set. Each set may miss only so many for the intersection a link needs.
    """
    own = lambda x: heads.select(F.col("class").alias(x), F.col("n").alias(f"_n{x}"), F.col("_prefix").alias(f"_p{x}"))
    shared = pairs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for t in batches:
            keep = []
            for n, m, x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist(), t.column(4), t.column(5)):
                x, y = (v.values.to_numpy().view(U64) for v in (x, y))
                both = in_order(np.union1d(x, y), counts)
                in_x, in_y = np.isin(both, x), np.isin(both, y)
                last = min(np.flatnonzero(in_x)[-1], np.flatnonzero(in_y)[-1]) + 1  # up to here both sets are fully known
                need = -(-percent * (n + m) // (100 + percent))
                keep.append((in_x & ~in_y)[:last].sum() <= n - need and (in_y & ~in_x)[:last].sum() <= m - need)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "_na", "_nb", "_pa", "_pb")
    return rows.mapInArrow(run, "a long, b long")


def _sets_of(base: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(class, set) for the texts of the given ids, with one pass over the texts of ``base``.

    A bitmap of ``SLOTS`` hashed ids, built by Spark and of fixed size, goes to the pass, which
    skips most other texts; what a shared slot lets through is dropped by the join. So only the sets that are wanted are shuffled.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(SLOTS))
    part = classes.select((slot("class") + 1).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m"))
    table = np.zeros(SLOTS, bool)
    for r in part.collect():
        bits = np.unpackbits(np.frombuffer(r["m"], np.uint8), bitorder="little")
        table[(r["k"] - 1) * len(bits):r["k"] * len(bits)] = bits
    shared = base.sparkSession.sparkContext.broadcast(np.packbits(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        for b in batches:
            b = b.filter(pa.array(wanted[b.column(2).to_numpy()]))
            if b.num_rows:
                yield pa.record_batch([b.column(0), pa.array([x.tobytes() for x in shingle_sets(b.column(1), k)], pa.binary())], names=["class", "set"])

    found = base.filter(F.col("id").isNotNull()).select("id", "text", slot("id").alias("slot")).mapInArrow(run, "class long, set binary")
    return settled(found.join(classes, "class", "left_semi"), SETS_A_TASK)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by exact counting."""
    own = lambda x: sets.select(F.col("class").alias(x), F.col("set").alias(f"_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for x, y in zip(t.column(2), t.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(own("a"), "a").join(own("b"), "b").select("a", "b", "_a", "_b")
    return rows.mapInArrow(run, "a long, b long")


def link_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", percent: int = PERCENT, count_slots: int = COUNT_SLOTS, k: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id), one row for each row of ``docs``; shingles have ``k`` words.

    component_id is the smallest id reachable by links, the document's own included. A null, empty or wordless text links with
    nothing. Rows with equal ids are one document of several texts: they share a component. A row without an
    id links with nothing and its component_id is null. An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    counts = shingle_counts(base, "text", count_slots, k)
    described = prefixes(base, "text", counts, percent, k).drop("text").checkpoint()
    linkable = described.filter((F.col("n_shingles") > 0) & F.col("id").isNotNull())

    # Classes of equal sets, then groups of classes with equal prefix and size.
    classes = linkable.groupBy("_s1", "_s2", "n_shingles").agg(F.min(F.struct("id", "_g1", "_g2")).alias("_m")).select(
        "_s1", "_s2", F.col("n_shingles").alias("n"), F.col("_m.id").alias("class"), F.col("_m._g1").alias("_g1"), F.col("_m._g2").alias("_g2")).checkpoint()
    grouped = classes.groupBy("_g1", "_g2").agg(F.min("class").alias("gid"), F.count(F.lit(1)).alias("members"))
    member = classes.join(grouped, ["_g1", "_g2"]).select("class", "n", "gid", "members").checkpoint()
    # The prefix of a group is that of its smallest class; the id and the set's signature name the row to take it from.
    heads = classes.join(member.filter(F.col("class") == F.col("gid")).select("class"), "class").select(F.col("class").alias("id"), "_s1", "_s2")
    of_group = linkable.select("id", "_s1", "_s2", "_prefix").join(heads, ["id", "_s1", "_s2"]).select(F.col("id").alias("gid"), "_prefix").checkpoint()
    spread = of_group.select("gid", F.posexplode("_prefix").alias("pos", "token"))
    in_bucket = spread.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter(F.col("_n") > 1).select("gid", "pos", "token")
    # Buckets of classes: by a shared prefix shingle, or by a shared group.
    by_token = in_bucket.join(member, "gid").select(F.struct(F.lit(0).alias("k"), "token").alias("bucket"), "class", "n", "pos")
    by_group = member.filter(F.col("members") > 1).select(F.struct(F.lit(1).alias("k"), F.col("gid").alias("token")).alias("bucket"), "class", "n", F.lit(0).alias("pos"))
    buckets = by_token.union(by_group).checkpoint()
    wanted = buckets.select("class").distinct().join(member, "class").select("class", "n", "gid")
    heads = wanted.join(of_group, "gid").select("class", "n", "_prefix").checkpoint()

    links = done = None
    comp = None
    for turn in range(HUB_ROUNDS + 1):
        labelled = buckets.withColumn("comp", F.col("class")) if comp is None else buckets.join(
            comp.select(F.col("node").alias("class"), F.col("comp")), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
        order = F.col("class") if turn == 0 else F.xxhash64("class", F.lit(turn))  # another hub in every round
        hub = labelled.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "class", "n", "pos", "comp")).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        hub = hub.filter(F.col("lo") != F.col("hi")).select("bucket", "hub")
        if turn < HUB_ROUNDS:
            pairs = labelled.join(hub, "bucket").filter((F.col("comp") != F.col("hub.comp")) & _meet("n", "pos", "hub.n", "hub.pos", percent)).select("class", F.col("hub.class").alias("other"))
        else:
            left = labelled.join(hub.select("bucket"), "bucket")
            right = left.select("bucket", F.col("class").alias("other"), F.col("n").alias("m"), F.col("pos").alias("pos2"), F.col("comp").alias("comp2"))
            pairs = left.join(right, "bucket").filter((F.col("class") < F.col("other")) & (F.col("comp") != F.col("comp2")) & _meet("n", "pos", "m", "pos2", percent)).select("class", "other")
        pairs = pairs.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = settled(pairs)
        done = pairs if done is None else done.union(pairs)
        likely = settled(_possible(pairs, heads, counts, percent).distinct())
        sets = _sets_of(base, likely.select(F.explode(F.array("a", "b")).alias("class")).distinct().coalesce(likely.rdd.getNumPartitions()), k)
        found = settled(_verified(likely, sets, percent).distinct())
        links = found if links is None else links.union(found)
        if turn == 0 or found.limit(1).count():
            comp = connected_components(links)

    # Ids of several texts tie their classes together as well.
    of_doc = linkable.join(classes.select("_s1", "_s2", F.col("n").alias("n_shingles"), "class"), ["_s1", "_s2", "n_shingles"]).select("id", "class")
    several = of_doc.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.collect_set("class").alias("_all")).filter(F.col("a") != F.col("b"))
    ties = settled(several.select("a", F.explode("_all").alias("b")).filter(F.col("a") != F.col("b")))
    if ties.limit(1).count():
        comp = connected_components(links.union(ties))
    of_class = of_doc.select("id", "class").distinct().join(comp.select(F.col("node").alias("class"), "comp"), "class", "left")
    of_id = of_class.groupBy("id").agg(F.min(F.coalesce("comp", "class")).alias("_c"))
    out = described.select("id", "n_shingles").join(of_id, "id", "left")
    return out.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("_c")).otherwise(F.col("id")).alias("component_id"))
