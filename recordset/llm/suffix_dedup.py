"""Exact repeats across a corpus by a common-prefix-aware distributed merge sort of suffixes.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts
earlier: in a document of smaller id, or earlier in the same one.

Not every suffix is sorted. Of the ``LENGTH - GRAM + 1`` grams of ``GRAM`` bytes in a string of
LENGTH bytes the one with the least hash (the first of equals) is its anchor; equal strings have
their anchors at equal places, so repeats can only meet at equal anchor grams, and one suffix in
some forty is enough. Anchors whose gram occurs once are dropped.

Each task sorts the suffixes at its anchors (LENGTH bytes to the right, then the bytes to
the left read backwards), merges equal ones and hands on sorted runs, front-coded: the length of the prefix shared with
the entry before, and the rest. The runs of one bucket of grams are combined by a loser
tree that keeps, for every run, the prefix it shares with the last entry put out: unequal lengths decide a match at once, equal ones
are compared from there on, so no known prefix is compared again. What comes out is the sorted suffixes with
their common prefix lengths. For each distance o from string start to anchor, entries are the same string when their common prefix covers
LENGTH - o bytes and their o bytes to the left agree; all but the earliest of them are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordset.llm.frames import dealt_alike, dealt_alike, map_text
from recordset.llm.textvec import U64, Chunk, chunks, column_bytes, mix

LENGTH = 100
GRAM = 16
LEFT = LENGTH - GRAM  # bytes that can stand before an anchor within a string
WIDTH = LENGTH + LEFT  # bytes of a sorted entry, without the two that count the real ones
# Anchors and entries a task gathers before it hands them on.
FLUSH_ANCHORS = 1_000_000
FLUSH_ENTRIES = 150_000
# Entries compared at a time, and rows whose texts are cut at a time: both bound what a task holds besides its input.
COMPARED = 8_192
CUT_ROWS = 500
# Buckets a shuffle partition: smaller ones are easier to balance.
BUCKETS_PER_PARTITION = 4


def anchors(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(place, gram hash) of all anchors of the chunk's texts."""
    n = len(c.buf)
    none = np.zeros(0, np.int64), np.zeros(0, U64)
    if n < LENGTH:
        return none
    at = np.arange(n - GRAM + 1)
    h = c.hash(at, at + GRAM)
    bits = max(20, int(n).bit_length())
    low = U64((1 << bits) - 1)
    key = (h & ~low) | at.astype(U64)  # the least key is the least hash, and of equals the first
    span = LENGTH - GRAM + 1
    blocks = np.concatenate([key, np.full(-len(key) % span, ~U64(0))]).reshape(-1, span)
    to_left = np.minimum.accumulate(blocks, axis=1).ravel()
    to_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - LENGTH + 1)
    least = np.minimum(to_right[starts], to_left[starts + span - 1])
    ends = np.repeat(c.offsets[1:], np.diff(c.offsets))[starts]
    least = least[starts + LENGTH <= ends]
    if not len(least):
        return none
    place = np.unique((least[np.append(True, least[1:] != least[:-1])] & low).astype(np.int64))
    return place, h[place]


CANDIDATES = T.StructType([T.StructField("key", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("row", T.LongType()),
                           T.StructField("pos", T.IntegerType()), T.StructField("many", T.ArrayType(T.IntegerType()))])
SINGLE, MARK, KNOWN = 0, 1, 2


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors met once in this task with their gram, one mark for each gram met more often, and the places of those."""
    schema = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("row", pa.int64()), ("pos", pa.int32()), ("many", pa.list_(pa.int32()))])
    parts: list[tuple] = []
    size = 0

    def hand_on() -> Iterator[pa.RecordBatch]:
        h, row, pos = (np.concatenate([p[i] for p in parts]) for i in range(3))
        parts.clear()
        keys, first, inverse, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        once = first[count == 1]
        n = len(once)
        for i in range(0, n, 200_000):
            s = once[i:i + 200_000]
            yield pa.record_batch([pa.array(h[s].view(np.int64)), pa.array(np.full(len(s), SINGLE, np.int32)), pa.array(row[s]), pa.array(pos[s].astype(np.int32)),
                                   pa.nulls(len(s), pa.list_(pa.int32()))], schema=schema)
        marked = keys[count > 1].view(np.int64)
        m = len(marked)
        yield pa.record_batch([pa.array(marked), pa.array(np.full(m, MARK, np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.list_(pa.int32()))], schema=schema)
        many = np.flatnonzero(count[inverse] > 1)
        rows, begin = np.unique(row[many], return_index=True)  # the anchors of a row stand together
        order = np.argsort(begin)
        rows, begin = rows[order], np.append(begin[order], len(many))
        lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(pos[many].astype(np.int32)))
        k = len(rows)
        yield pa.record_batch([pa.array(mix(rows.astype(U64)).view(np.int64)), pa.array(np.full(k, KNOWN, np.int32)), pa.array(rows), pa.nulls(k, pa.int32()), lists], schema=schema)

    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for c in chunks(b.column(1)):
            place, h = anchors(c)
            text = c.text_of(place)
            parts.append((h, ids[c.first + text], place - c.offsets[text]))
            size += len(place)
            if size >= FLUSH_ANCHORS:
                yield from hand_on()
                size = 0
    if parts:
        yield from hand_on()


RUNS = T.StructType([T.StructField("bucket", T.IntegerType())] + [T.StructField(n, T.BinaryType()) for n in ("lcp", "tails", "doc", "row", "pos")])
RUN_SCHEMA = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("lcp", "tails", "doc", "row", "pos")])


def entries(buf: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One row a place: LENGTH bytes to the right, LEFT bytes to the left backwards, zeros beyond the text, and how many are real."""
    right = places[:, None] + np.arange(LENGTH)
    left = places[:, None] - 1 - np.arange(LEFT)
    out = np.zeros((len(places), WIDTH + 2), np.uint8)
    out[:, :LENGTH] = np.where(right < len(buf), buf[np.minimum(right, len(buf) - 1)], 0)
    out[:, LENGTH:WIDTH] = np.where(left >= 0, buf[np.maximum(left, 0)], 0)
    out[:, WIDTH] = np.minimum(len(buf) - places, LENGTH)
    out[:, WIDTH + 1] = np.minimum(places, LEFT)
    return out


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), COMPARED):
        differ = a[i:i + COMPARED] != b[i:i + COMPARED]
        out[i:i + COMPARED] = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return out


def covered(own: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start, end) of what an entry whose every string is a repeat covers."""
    low, high = np.maximum(LENGTH - own[:, WIDTH].astype(np.int64), 0), own[:, WIDTH + 1].astype(np.int64)
    some = np.flatnonzero(low <= high)
    return some, pos[some] - high[some], pos[some] - low[some] + LENGTH


def cover_batch(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Covered stretches on their way past the merge, in buckets below 0 that are spread by row."""
    order = np.lexsort((start, rows))
    rows, start, end = rows[order], start[order], end[order]
    # Join overlapping stretches of a row.
    reach = np.maximum.accumulate(end + (np.cumsum(np.append(True, rows[1:] != rows[:-1])) << 32) if len(rows) else end)
    reach = reach - (np.cumsum(np.append(True, rows[1:] != rows[:-1])) << 32) if len(rows) else reach
    new = np.append(True, (rows[1:] != rows[:-1]) | (start[1:] > reach[:-1])) if len(rows) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(rows)) - 1
    rows, start, end = rows[head], start[head], reach[last] if len(rows) else end
    spread = (mix(rows.astype(U64)) >> U64(44)).astype(np.int64) & 1023
    order = np.argsort(spread, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(spread[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    out: list[list] = [[] for _ in RUN_SCHEMA.names]
    for a, b in zip(cut, np.append(cut[1:], len(order))):
        s = order[a:b]
        for o, v in zip(out, (-1 - int(spread[s[0]]), None, None, start[s].astype(np.int32).tobytes(), rows[s].tobytes(), end[s].astype(np.int32).tobytes())):
            o.append(v)
    return pa.record_batch([pa.array(o, f.type) for o, f in zip(out, RUN_SCHEMA)], schema=RUN_SCHEMA)


def run_batch(own: np.ndarray, doc: np.ndarray, row: np.ndarray, pos: np.ndarray, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Sort entries, settle those equal to an earlier one of this task, and front-code the others by bucket."""
    order = np.lexsort((pos, row, doc))
    own, doc, row, pos = own[order], doc[order], row[order], pos[order]
    order = np.argsort(own.view(f"S{WIDTH + 2}").ravel(), kind="stable")
    own, doc, row, pos = own[order], doc[order], row[order], pos[order]
    same = np.append(False, common_prefix(own[1:], own[:-1]) == WIDTH + 2) if len(own) else np.zeros(0, bool)
    again, start, end = covered(own[same], pos[same])
    yield cover_batch(row[same][again], start, end)
    own, doc, row, pos = own[~same], doc[~same], row[~same], pos[~same]
    gram = np.ascontiguousarray(own[:, :GRAM]).view(U64)
    bucket = (mix(gram[:, 0] ^ mix(gram[:, 1])) % U64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    own, doc, row, pos, bucket = own[order], doc[order], row[order], pos[order], bucket[order]
    lcp = np.append(0, common_prefix(own[1:], own[:-1])) if len(own) else np.zeros(0, np.int64)
    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(own) else np.zeros(0, np.int64)
    lcp[cut] = 0
    out: list[list] = [[] for _ in RUN_SCHEMA.names]
    for a, b in zip(cut, np.append(cut[1:], len(own))):
        tails = own[a:b][np.arange(WIDTH + 2) >= lcp[a:b, None]]
        packed = len(tails).to_bytes(8, "little") + pa.compress(tails.tobytes(), codec="zstd", asbytes=True)
        values = (int(bucket[a]), lcp[a:b].astype(np.uint8).tobytes(), packed, doc[a:b].tobytes(), row[a:b].tobytes(), pos[a:b].astype(np.int32).tobytes())
        for o, v in zip(out, values):
            o.append(v)
    yield pa.record_batch([pa.array(o, f.type) for o, f in zip(out, RUN_SCHEMA)], schema=RUN_SCHEMA)


def _runs(n_buckets: int, columns: list[str]):
    """Sorted runs of the rows' suffixes, from batches of the given columns."""
    at_doc, at_row, at_text, at_places = (columns.index(c) for c in ("_doc", "_row", "_text", "_places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = 0

        def hand_on() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate([p[i] for p in parts]) for i in (3, 2, 1, 0)]
            parts.clear()
            return run_batch(columns.pop(), columns.pop(), columns.pop(), columns.pop(), n_buckets)

        for b in batches:
            buf, offsets = column_bytes(b.column(at_text))
            doc, row = (b.column(i).to_numpy(zero_copy_only=False) for i in (at_doc, at_row))
            for i, places in enumerate(b.column(at_places)):
                at = np.unique(places.values.to_numpy())
                text = buf[offsets[i]:offsets[i + 1]]
                for j in range(0, len(at), FLUSH_ENTRIES):
                    own = at[j:j + FLUSH_ENTRIES].astype(np.int64)
                    parts.append((entries(text, own), np.full(len(own), doc[i], np.int64), np.full(len(own), row[i], np.int64), own))
                    size += len(own)
                    if size >= FLUSH_ENTRIES:
                        yield from hand_on()
                        size = 0
        if parts:
            yield from hand_on()

    return run


def decode_run(lcp: bytes, tails: bytes) -> Iterator[tuple[int, bytes]]:
    """(prefix shared with the entry before, entry) of a front-coded run."""
    tails = pa.decompress(tails[8:], int.from_bytes(tails[:8], "little"), codec="zstd", asbytes=True)
    last, at = b"", 0
    for n in lcp:
        end = at + WIDTH + 2 - n
        last = last[:n] + tails[at:end]
        at = end
        yield n, last


def merge_runs(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """(prefix shared with the entry before, entry, run) in sorted order, by a loser tree over the runs.

    A node holds the loser of its match with the prefix it shares with the last entry put out. The
    run that wins goes on with its next entry, whose front code is just that prefix.
    """
    k = 1
    while k < len(runs):
        k *= 2
    entry: list[bytes | None] = [None] * k
    shared = [0] * k

    def match(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's shared prefix becomes the one with the winner."""
        x, y = entry[a], entry[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        n = shared[a]
        if n != shared[b]:
            return (a, b) if n > shared[b] else (b, a)
        size = len(x)
        differ = int.from_bytes(x[n:], "big") ^ int.from_bytes(y[n:], "big")
        n = size - (differ.bit_length() + 7) // 8
        if n == size or x[n] < y[n]:
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    for i, r in enumerate(runs):
        _, entry[i] = next(r, (0, None))
    loser = [0] * k
    winners = list(range(k))
    base = k
    while base > 1:  # first round: every run against its neighbour, the winners again
        base //= 2
        nxt = []
        for j in range(base):
            w, lost = match(winners[2 * j], winners[2 * j + 1])
            loser[base + j] = lost
            nxt.append(w)
        winners = nxt
    best = winners[0]
    while entry[best] is not None:
        yield shared[best], entry[best], best
        n, e = next(runs[best], (0, None))
        shared[best], entry[best] = n, e
        node = (k + best) // 2
        while node:
            best, loser[node] = match(best, loser[node])
            node //= 2


def repeats(own: np.ndarray, lcp: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, first distance, last distance) of the strings that an earlier entry has as well.

    ``own`` is sorted, ``lcp`` the common prefix with the entry before, and ``order`` says which entry is earlier.
    """
    right = np.minimum(lcp, LENGTH)
    with_next = np.append(right[1:], 0) >= GRAM
    used = np.flatnonzero(with_next | (right >= GRAM))  # others share no gram with a neighbour
    if not len(used):
        z = np.zeros(0, np.int64)
        return z, z, z
    # Earliest first, so that the first entry of a string is the earliest.
    by_age = used[np.argsort(order[used], kind="stable")]
    n_right, n_left = own[by_age, WIDTH], own[by_age, WIDTH + 1]
    seen = np.zeros((len(by_age), LEFT + 2), bool)
    left_hash = np.zeros(len(by_age), U64)
    for o in range(LEFT + 1):
        if o:
            left_hash = mix(left_hash ^ own[by_age, LENGTH + o - 1].astype(U64) + U64(o << 9))
        same_right = np.cumsum(right < LENGTH - o)[by_age].astype(U64)
        real = np.flatnonzero((n_right >= LENGTH - o) & (n_left >= o))
        if not len(real):
            continue
        key = mix(left_hash[real] + same_right[real] * U64(0x9E3779B97F4A7C15))
        at = np.argsort(key, kind="stable")
        k = key[at]
        seen[real[at], o] = np.append(False, k[1:] == k[:-1])
    edge = np.diff(np.pad(seen.astype(np.int8), ((0, 0), (1, 0))), axis=1)
    entry, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return by_age[entry], first, last - 1


COVERS = T.StructType([T.StructField("row", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one bucket after another; the rows come sorted by bucket."""
    schema = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def out(rows, start, end) -> pa.RecordBatch:
        return pa.record_batch([pa.array(rows, pa.int64()), pa.array(np.asarray(start, np.int32)), pa.array(np.asarray(end, np.int32))], schema=schema)

    def settle(group: list[tuple]) -> pa.RecordBatch:
        doc, row, pos = ([np.frombuffer(g[i], t) for g in group] for i, t in ((2, np.int64), (3, np.int64), (4, np.int32)))
        lcp, strings, source = [], [], []
        for n, e, r in merge_runs([decode_run(g[0], g[1]) for g in group]):
            lcp.append(n)
            strings.append(e)
            source.append(r)
        own = np.frombuffer(b"".join(strings), np.uint8).reshape(-1, WIDTH + 2)
        # The entries of a run come out in their order, so a stable sort by run pairs them with their places.
        at = np.argsort(np.array(source), kind="stable")
        place = np.empty((3, len(own)), np.int64)
        place[:, at] = [np.concatenate(doc), np.concatenate(row), np.concatenate(pos)]
        age = np.empty(len(own), np.int64)
        age[np.lexsort((place[2], place[1], place[0]))] = np.arange(len(own))
        e, first, last = repeats(own, np.array(lcp), age)
        return out(place[1][e], place[2][e] - last, place[2][e] - first + LENGTH)

    bucket, group = None, []
    for b in batches:
        for k, one in enumerate(b.column(0).to_pylist()):
            rest = [b.column(i)[k].as_py() for i in range(1, 6)]
            if one < 0:
                yield out(np.frombuffer(rest[3], np.int64), np.frombuffer(rest[2], np.int32), np.frombuffer(rest[4], np.int32))
                continue
            if one != bucket and group:
                yield settle(group)
                group = []
            bucket = one
            group.append(tuple(rest))
    if group:
        yield settle(group)


def repeated_spans(rows: DataFrame, n_buckets: int) -> DataFrame:
    """(_row, _spans): the covered stretches of each row that has any, from columns _doc, _row and _text.

    All columns of ``rows`` go through the join with the places, so that its shuffle of the
    texts is the one that the caller's join with the spans needs as well, and Spark makes it once.
    """
    found = rows.select("_row", "_text").mapInArrow(_candidates, CANDIDATES)
    same = F.count(F.lit(1)).over(Window.partitionBy("key"))
    places = found.withColumn("n", same).filter((F.col("kind") == KNOWN) | ((F.col("kind") == SINGLE) & (F.col("n") > 1)))
    places = places.select("row", F.when(F.col("kind") == KNOWN, F.col("many")).otherwise(F.array("pos")).alias("many"))
    places = places.groupBy("row").agg(F.flatten(F.collect_list("many")).alias("places"))
    placed = rows.join(places.withColumnRenamed("row", "_row").withColumnRenamed("places", "_places"), "_row")
    runs = placed.mapInArrow(_runs(n_buckets, placed.columns), RUNS)
    covers = runs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge, COVERS)
    return covers.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("start", "end")).alias("_spans"))


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept_sha256, and with ``keep_text`` the text that is left in place of the old one.

    Texts are taken as UTF-8 bytes; what is left of a character cut in two is dropped from the text, not from the digest. A null text is
    empty and loses nothing. Ids are whole numbers (others fail the cast) and come in ascending order, a null id last, and rows of equal id in the order of the scan, so of
    repeated rows one stays. Columns named like a new one are replaced; others may have any names. An empty table gives no rows.

    Rows are told apart by their place, so ``docs`` must be dealt alike whenever it is evaluated: anything but a selection from files
    is written to the checkpoint folder first.
    """
    spark = docs.sparkSession
    new = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    docs = dealt_alike(docs)
    columns = docs.columns
    kept = [i for i, c in enumerate(columns) if c != text and c.lower() not in new]
    own = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    at = lambda c: F.col(f"c{columns.index(c)}")
    rows = own.select(*(f"c{i}" for i in kept), at(text).alias("_text"), F.monotonically_increasing_id().alias("_row"),
                      F.coalesce(at(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("_doc"))
    n_buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = rows.join(repeated_spans(rows, n_buckets), "_row", "left")

    def make():
        def cut(col: pa.Array, spans: pa.Array) -> list:
            buf, offsets = column_bytes(col)
            out: list[list] = [[] for _ in range(5)]
            for i, own in enumerate(spans):
                raw = buf[offsets[i]:offsets[i + 1]]
                gone = np.zeros(len(raw) + 1, np.int64)
                if own.is_valid:
                    np.add.at(gone, own.values.field("start").to_numpy(), 1)
                    np.add.at(gone, own.values.field("end").to_numpy(), -1)
                away = np.cumsum(gone)[:-1] > 0
                left = raw[~away].tobytes()
                values = (len(raw), int(away.sum()), int(away[0:1].sum() + (away[1:] & ~away[:-1]).sum()), hashlib.sha256(left).hexdigest(),
                          left.decode("utf-8", "ignore") if keep_text else None)
                for o, v in zip(out, values):
                    o.append(v)
            return out

        return cut

    long = T.LongType()
    fields = [T.StructField(n, long) for n in new[:3]] + [T.StructField("kept_sha256", T.StringType()), T.StructField("_left", T.StringType())]
    out = map_text(joined, "_text", make, fields, ("_spans",), rows=CUT_ROWS).drop("_row", "_doc", "_spans", "_text")
    names = [columns[i] for i in kept] + list(new)
    return out.toDF(*names, text) if keep_text else out.drop("_left").toDF(*names)
