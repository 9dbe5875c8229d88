"""Mixing sources to target weights by Pfair scheduling.

The rows of a source, in the order of a seeded hash, are cut into blocks of
``block_rows``. With integer weights n_i that add up to D, block j of source i
is released at slot floor(j * D / n_i) and due by slot ceil((j + 1) * D / n_i);
in every slot the released block that is due first is placed. On one sequence
this meets every deadline, so after any t slots a source has placed less than one block more or
less than its share t * n_i / D. The integers are the weights themselves, scaled and not rounded, so the share is the exact one.
When a source has no blocks left, a new phase begins in which the others share the slots by their weights.
The schedule has one entry a block and is worked out on the driver; the rows are joined to it.
Every row is placed once.

Ranks within a source come from two levels: rows are dealt to buckets by
their hash, the sizes of the buckets are added up, and only the rows of one bucket are numbered together,
so a source of any size is spread over many tasks.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 64
BUCKET_ROWS = 256
# The schedule has a phase for each source that runs out and is worked out on the driver, so the number of sources is bounded.
MAX_SOURCES = 1000
SEED = 4241


def whole_weights(weights: dict, period: int) -> dict:
    """Integers of at least 1 in proportion to the weights, adding up to ``period`` (largest remainders, ties by name)."""
    total = sum(weights.values())
    names = sorted(weights)
    spare = period - len(names)  # one slot each, the rest by weight
    exact = {s: spare * weights[s] / total for s in names}
    out = {s: 1 + math.floor(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: (math.floor(exact[s]) - exact[s], s))[:period - sum(out.values())]:
        out[s] += 1
    return out


def exact_weights(weights: dict) -> dict:
    """Integers in the very proportion of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    return {s: w // common for s, w in whole.items()}


def pfair_period(n: dict, blocks: dict | None = None) -> dict:
    """Slots of each source's blocks, earliest deadline first among the released, for one period or until a source has placed its ``blocks``."""
    d = sum(n.values())
    waiting = [(0, s, 0) for s in sorted(n)]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict = {s: [] for s in n}
    t = -1
    while (t := t + 1) < d:
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * d // n[s]), s, j))
        due, s, j = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a deadline was missed")
        slots[s].append(t)
        if blocks is not None and j + 1 == blocks[s]:
            break
        if j + 1 < n[s]:
            heapq.heappush(waiting, ((j + 1) * d // n[s], s, j + 1))
    return slots


def pfair_phase(n: dict, blocks: dict) -> dict:
    """Slots of each source's blocks over as many periods as it takes until the first source has placed all of its ``blocks``."""
    d, left, begin = sum(n.values()), dict(blocks), 0
    slots: dict = {s: [] for s in n}
    while all(left.values()):
        for s, at in pfair_period(n, left).items():
            slots[s] += [begin + t for t in at]
            left[s] -= len(at)
        begin += d
    return slots


def phases(blocks: dict, weights: dict, period: int | None = None) -> list[dict]:
    """For each phase and source: first and end block, first slot, and the slots of the blocks within the phase.

    ``per_period`` of ``period`` slots is the source's share.
    """
    left, done, slot, out = dict(blocks), {s: 0 for s in blocks}, 0, []
    number = 0
    while left := {s: b for s, b in left.items() if b > 0}:
        own = {s: weights[s] for s in left}
        n = exact_weights(own) if period is None else whole_weights(own, max(period, 2 * len(left)))
        d = sum(n.values())
        # The phase ends after the last block of the source that runs out first.
        pattern = pfair_phase(n, left)
        for s, at in pattern.items():
            if at:
                out.append({"source": s, "phase": number, "first_block": done[s], "end_block": done[s] + len(at), "first_slot": slot,
                            "per_period": n[s], "period": d, "pattern": at})
            done[s] += len(at)
            left[s] -= len(at)
        slot += sum(map(len, pattern.values()))
        number += 1
    return out


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", id_col: str = "doc_id",
                block_rows: int = BLOCK_ROWS, bucket_rows: int = BUCKET_ROWS, period: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``block`` (its number within the source), ``slot`` (place of the block in the mix) and ``place`` (within the block).

    Reading by (slot, place) gives the mix; every row is placed once. ``weights`` are target shares by source name; without
    them a source weighs the square root of its rows. ``period`` rounds the weights to whole slots of that many for a caller who asks for it. A source that is not named, or has a weight of 0 or less, gets the
    least positive weight. A null source is a source of its own, named ''. Rows with equal ids, repeated rows included, are told apart by
    their content and then by chance, which changes neither blocks nor slots. An empty table gives no rows.
    """
    new = ("block", "slot", "place")
    names = [c for c in docs.columns if c.lower() not in new]
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    keyed = docs.select(*names, name.alias("_source"), F.xxhash64(F.lit(seed), F.col(id_col).cast("string")).alias("_h"))
    sizes = {r["_source"]: r["n"] for r in keyed.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them first")
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    given = {s: w for s, w in (weights or {}).items() if w > 0}
    least = min(given.values(), default=1.0)
    target = {s: (given.get(s, least) if weights else math.sqrt(n)) for s, n in sizes.items()}
    plan = phases(blocks, target, period)

    spark = docs.sparkSession
    counts = spark.createDataFrame([(s, max(1, -(-n // bucket_rows))) for s, n in sizes.items()], "_source string, _buckets long")
    # One row a source: MAX_SOURCES bounds what is broadcast.
    keyed = keyed.join(F.broadcast(counts), "_source").withColumn("_bucket", F.pmod(F.col("_h"), F.col("_buckets")))
    bucket_sizes = keyed.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = bucket_sizes.select("_source", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    # One row a bucket. The join takes the same partitioning as the numbering below, so the rows move once.
    ranked = keyed.join(begins, ["_source", "_bucket"])
    within = Window.partitionBy("_source", "_bucket").orderBy("_h", F.col(id_col))
    rank = F.col("_begin") + F.row_number().over(within) - 1
    ranked = ranked.withColumn("_rank", rank)
    block = F.floor(F.col("_rank") / block_rows).cast("long")
    placed = ranked.withColumn("block", block).withColumn("place", F.pmod(F.col("_rank"), F.lit(block_rows)).cast("long"))
    # One row a block, so this table is broadcast only where it is small.
    entries = [(x["source"], x["first_block"] + i, x["first_slot"] + t) for x in plan for i, t in enumerate(x["pattern"])]
    columns = zip(*entries) if entries else ([], [], [])
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))]
    steps = spark.createDataFrame(pa.table(arrays, names=["_s", "_block", "slot"]))
    placed = placed.join(steps, (F.col("_source") == F.col("_s")) & (F.col("block") == F.col("_block")))
    return placed.select(*names, "block", "slot", "place")
