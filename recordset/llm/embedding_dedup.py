"""Near duplicates among embeddings by sorted projection passes.

Equal vectors of one label first become a class. In each pass every class gets a key, the signs of its
projections on 63 random directions as bits, and all classes are ordered by (label, key): vectors at a small angle agree
in each sign with probability 1 - angle / pi, so they tend to stand near each other. Each vector is compared with those
of its label in the ``WINDOW`` places after it. All passes are one shuffle: the rows (pass, label, key, vector) are
cut into sorted ranges. A task hands on the pairs it verified as a star for each group it found, one row for a vector at most, so a
dense group of any size costs its size in each pass. The union of all passes gives the components.

The number of passes follows from the input, so that a pair at the threshold is found with probability 1 - ``MISS`` whatever the size:
with n vectors in a label it must agree in log2(n / WINDOW) signs to meet in a pass. Nearer pairs are found much more surely, and
components hold together by any chain of links.

Windows bound what a pass compares, not what is counted: links are then counted exactly within each component, over all its
vectors, in blocks, without listing pairs. In a large component the triangle inequality for angles comes first: a vector within
(threshold - r) of the centre of a component of radius r is linked with every member, so only what lies further out is compared, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm.components import connected_components, settled

COSINE = 0.93
# Neighbours after each vector that a pass compares it with.
WINDOW = 48
# Probability with which a pair exactly at the threshold may be missed by all passes.
MISS = 1e-3
MIN_PASSES = 4
BITS = 63
SEED = 20_011
# Vectors that one task of a pass sorts.
ROWS_A_TASK = 50_000
# Vectors of a component that one matrix of cosines has on a side.
BLOCK = 2048
# Angles closer than this to the threshold are left to the exact comparison.
MARGIN = 1e-6


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes needed for labels of up to ``n`` vectors."""
    agree = 1 - math.acos(cosine) / math.pi
    met = agree ** max(math.log2(max(n, 1) / window), 0)
    return max(MIN_PASSES, math.ceil(math.log(miss) / math.log1p(-met)) if met < 1 else 1)


def _packed(vectors: DataFrame, vec_col: str, id_col: str, label_col: str) -> DataFrame:
    """(id, grp, h1, h2, vec): the bytes of each usable vector, all null but the id for rows that link with nothing."""
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    dtype = np.float32 if single else np.float64
    cast = f"array<{'float' if single else 'double'}>"
    id_type = vectors.schema[id_col].dataType
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vec_col}`").cast(cast).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(2)
            n = np.asarray(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False), np.int64)
            x = np.ascontiguousarray(col.flatten().to_numpy(zero_copy_only=False), dtype)  # nulls become NaN
            at = np.concatenate([[0], np.cumsum(n)])
            row = np.repeat(np.arange(len(n)), n)
            bad = np.bincount(row, weights=~np.isfinite(x), minlength=len(n)) > 0
            some = np.bincount(row, weights=x != 0, minlength=len(n)) > 0
            ok = some & ~bad & ~b.column(1).is_null().to_numpy(zero_copy_only=False) & ~b.column(0).is_null().to_numpy(zero_copy_only=False)
            raw, w = x.tobytes(), x.itemsize
            vec = pa.array([raw[s * w:e * w] if k else None for k, s, e in zip(ok, at[:-1].tolist(), at[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), vec], names=["id", "label", "vec"])

    fields = [T.StructField("id", id_type), T.StructField("label", vectors.schema[label_col].dataType), T.StructField("vec", T.BinaryType())]
    out = rows.mapInArrow(run, T.StructType(fields))
    size = F.length("vec")
    there = lambda c: F.when(F.col("vec").isNotNull(), c)
    return out.select("id", there(F.xxhash64("label", size)).alias("grp"), there(F.xxhash64("vec")).alias("h1"),
                      there(F.xxhash64("vec", F.lit(SEED))).alias("h2"), "vec"), dtype


def unit_rows(col: pa.Array, dtype) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(col.to_pylist()), dtype).astype(np.float64).reshape(len(col), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of equal values."""
    cut = np.flatnonzero(np.diff(values)) + 1
    return list(zip([0, *cut.tolist()], [*cut.tolist(), len(values)])) if len(values) else []


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the least place it is connected with over the pairs (a, b)."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _lengths(col: pa.Array) -> np.ndarray:
    return np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), np.int64)


def _keyed(classes: DataFrame, passes: int, dtype) -> DataFrame:
    """(pass, size, grp, key, cls, vec): every class in every pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            size = _lengths(b.column(2))
            for length in np.unique(size).tolist():
                rows = b.filter(pa.array(size == length))
                u = unit_rows(rows.column(2), dtype)
                for p in range(passes):
                    if (length, p) not in directions:
                        directions[length, p] = np.random.default_rng([SEED, length, p]).standard_normal((u.shape[1], BITS))
                    bits = np.zeros((len(u), BITS + 1), bool)
                    bits[:, 1:] = u @ directions[length, p] > 0
                    key = np.packbits(bits, axis=1).view(">i8").ravel().astype(np.int64)
                    k = len(u)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, p, np.int32)), pa.array(np.full(k, length, np.int32)), rows.column(1), pa.array(key), rows.column(0), rows.column(2)],
                        names=["pass", "size", "grp", "key", "cls", "vec"])

    schema = T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("grp", T.LongType()),
                           T.StructField("key", T.LongType()), classes.schema["cls"], T.StructField("vec", T.BinaryType())])
    return classes.select("cls", "grp", "vec").mapInArrow(run, schema)


def _window_links(ordered: DataFrame, cosine: float, window: int, dtype) -> DataFrame:
    """(a, b): for the links found in the windows of each sorted range, a star for each connected group of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b] if rest is None else [rest, b]).combine_chunks()
            t = t.to_batches()[0] if t.num_rows else b
            rest = t.slice(max(0, t.num_rows - window))
            for s, e in _runs(t.column(1).to_numpy()):
                part = t.slice(s, e - s)
                u = unit_rows(part.column(5), dtype)
                place, grp = part.column(0).to_numpy(), part.column(2).to_numpy()
                segment = np.concatenate([[0], np.cumsum((np.diff(place) != 0) | (np.diff(grp) != 0))])
                first, second = [], []
                for d in range(1, min(window, len(u) - 1) + 1):
                    same = np.flatnonzero(segment[d:] == segment[:-d])
                    if not len(same):
                        break
                    hit = same[np.einsum("ij,ij->i", u[same], u[same + d]) >= cosine]
                    first.append(hit)
                    second.append(hit + d)
                if sum(map(len, first)):
                    root = _stars(len(u), np.concatenate(first), np.concatenate(second))
                    out = np.flatnonzero(root != np.arange(len(u)))
                    cls = part.column(4)
                    yield pa.RecordBatch.from_arrays([cls.take(pa.array(out)), cls.take(pa.array(root[out]))], names=["a", "b"])

    t = ordered.schema["cls"].dataType
    return ordered.mapInArrow(run, T.StructType([T.StructField("a", t), T.StructField("b", t)]))


_COUNTED = "grp long, h1 long, h2 long, links long"


def _counts(table: pa.Table, links: np.ndarray) -> pa.Table:
    return pa.table([table["grp"], table["h1"], table["h2"], pa.array(links.astype(np.int64))], names=["grp", "h1", "h2", "links"])


def _count_small(members: DataFrame, cosine: float, dtype) -> DataFrame:
    """Links of each class within its component, for components of one block; many of them share a bin."""
    bins = max(1, -(-members.count() // (8 * BLOCK)))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("grp", "ascending"), ("part", "ascending")])
        links = np.zeros(table.num_rows, np.int64)
        grp, part, n = (table[c].to_numpy() for c in ("grp", "part", "n"))
        for s, e in _runs(np.cumsum(np.concatenate([[0], (np.diff(grp) != 0) | (np.diff(part) != 0)]))):
            u = unit_rows(table["vec"].slice(s, e - s).combine_chunks(), dtype)
            near = u @ u.T >= cosine
            np.fill_diagonal(near, False)
            links[s:e] = near @ n[s:e]
        return _counts(table, links)

    binned = members.withColumn("part", F.xxhash64("comp")).withColumn("bin", F.pmod(F.xxhash64("part", "grp"), F.lit(bins)))
    return binned.groupBy("bin").applyInArrow(run, _COUNTED)


def _count_large(members: DataFrame, cosine: float, block: int, dtype) -> DataFrame:
    """Links of each class within its component, for components of any size."""
    limit = math.acos(cosine) - MARGIN

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, np.ndarray] = {}
        for b in batches:
            for key, at in _places(b.column(0), b.column(1)):
                total = unit_rows(b.column(2).take(at), dtype).sum(axis=0)
                found[key] = found.get(key, 0) + total
        for (comp, grp), total in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([comp], kind), pa.array([grp], pa.int64()), pa.array([total.tobytes()])], names=["comp", "grp", "centre"])

    def merged(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table["centre"].to_pylist())
        return pa.table([table["comp"].slice(0, 1), table["grp"].slice(0, 1), pa.array([total.tobytes()])], names=["comp", "grp", "centre"])

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = _lengths(b.column(names.index("vec")))
            for length in np.unique(size).tolist():
                rows = b.filter(pa.array(size == length))
                u, c = unit_rows(rows.column(names.index("vec")), dtype), unit_rows(rows.column(len(names)), np.float64)
                angle = np.arccos(np.clip(np.einsum("ij,ij->i", u, c), -1, 1))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(angle)], names=[*names, "angle"])

    from recordset.llm.frames import arrow_type

    kind, names = arrow_type(members.schema["comp"].dataType), members.columns
    key = T.StructType([members.schema["comp"], members.schema["grp"], T.StructField("centre", T.BinaryType())])
    centres = members.select("comp", "grp", "vec").mapInArrow(sums, key).groupBy("comp", "grp").applyInArrow(merged, key)
    placed = members.join(centres, ["comp", "grp"]).select(*names, "centre").mapInArrow(angles, T.StructType([*members.schema.fields, T.StructField("angle", T.DoubleType())])).checkpoint()
    radius = placed.groupBy("comp", "grp").agg(F.max("angle").alias("far"), F.sum("n").alias("total"))
    placed = placed.join(radius, ["comp", "grp"]).withColumn("inner", F.col("angle") + F.col("far") <= limit).checkpoint()
    inner = placed.filter("inner").select("grp", "h1", "h2", (F.col("total") - F.col("n")).alias("links"))

    outside = placed.groupBy("comp", "grp").agg(F.sum(F.when(~F.col("inner"), 1).otherwise(0)).alias("m"), F.sum(F.when(F.col("inner"), F.col("n")).otherwise(0)).alias("around"))
    outer = placed.filter(~F.col("inner")).join(outside, ["comp", "grp"]).withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    outer = outer.withColumn("i", F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int"))
    around = outer.select("grp", "h1", "h2", F.col("around").alias("links"))
    spread = outer.select("comp", "grp", "h1", "h2", "n", "vec", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    spread = spread.withColumn("lo", F.least("i", "j")).withColumn("hi", F.greatest("i", "j"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        i, lo, hi, n = (table[c].to_numpy() for c in ("i", "lo", "hi", "n"))
        u = unit_rows(table["vec"].combine_chunks(), dtype)
        links = np.zeros(len(u), np.int64)
        x, y = np.flatnonzero(i == lo), np.flatnonzero(i == hi)
        if lo[0] == hi[0]:
            near = u @ u.T >= cosine
            np.fill_diagonal(near, False)
            links = near @ n
        else:
            near = u[x] @ u[y].T >= cosine
            links[x], links[y] = near @ n[y], near.T @ n[x]
        return _counts(table, links)

    return inner.union(around).union(spread.groupBy("comp", "grp", "lo", "hi").applyInArrow(compare, _COUNTED))


def _places(*cols: pa.Array) -> Iterator[tuple[tuple, pa.Array]]:
    """Each combination of values with the places of its rows."""
    at: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*(c.to_pylist() for c in cols))):
        at.setdefault(key, []).append(i)
    for key, places in at.items():
        yield key, pa.array(places)


def link_vectors(vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label", cosine: float = COSINE,
                 window: int = WINDOW, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each row of ``vectors``.

    Vectors of one label and one length link when their cosine, in double precision, is at least ``cosine``. ``n_links`` counts the other rows a row is
    linked with, component_id is the smallest id reachable by links, and the row of that id is kept. Rows whose id, label or vector is null,
    whose vector is empty or zero or holds null or non-finite entries link with nothing: n_links 0, their own id, kept. Repeated rows are linked with each
    other; rows of one id and different vectors are counted one by one and share their component (each row of the smallest id is kept). No row is dropped; an empty
    table gives no rows. Other columns are not read, so their names do not matter. Ids may have any type that can be ordered.
    """
    packed, dtype = _packed(vectors, vec_col, id_col, label_col)
    usable = packed.filter(F.col("vec").isNotNull())
    classes = usable.groupBy("grp", "h1", "h2", "vec").agg(F.min("id").alias("cls"), F.count(F.lit(1)).alias("n")).checkpoint()
    largest = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("m")).agg(F.max("m"), F.sum("m")).first()
    passes = passes_for(largest[0] or 1, cosine, window, miss)
    ranges = max(1, -(-(largest[1] or 0) * passes // ROWS_A_TASK))
    order = ["pass", "size", "grp", "key", "cls"]
    ordered = _keyed(classes, passes, dtype).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    edges = settled(_window_links(ordered, cosine, window, dtype).distinct())
    comps = connected_components(edges)

    members = classes.join(comps.select(F.col("node").alias("cls"), "comp"), "cls")
    sizes = members.groupBy("comp", "grp").agg(F.count(F.lit(1)).alias("m"))
    members = members.join(sizes, ["comp", "grp"]).checkpoint()
    counted = _count_small(members.filter(F.col("m") <= block).drop("m"), cosine, dtype)
    large = members.filter(F.col("m") > block).drop("m")
    if large.limit(1).count():
        counted = counted.union(_count_large(large, cosine, block, dtype))
    counted = counted.groupBy("grp", "h1", "h2").agg(F.sum("links").alias("links"))

    names = members.select("grp", "h1", "h2", "comp").join(counted, ["grp", "h1", "h2"], "left")
    copies = classes.filter(F.col("n") > 1).select("grp", "h1", "h2", "cls", "n")
    known = names.join(copies, ["grp", "h1", "h2"], "full").select(
        "grp", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("links"), F.coalesce("comp", "cls").alias("comp"))
    out = packed.select("id", "grp", "h1", "h2").join(known, ["grp", "h1", "h2"], "left")
    comp = F.coalesce("comp", "id")
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(comp == F.col("id"), F.lit(True)).alias("kept"))
