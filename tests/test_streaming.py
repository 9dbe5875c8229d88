"""Streaming keyed writes: micro-batches merged into versions, replay skipped."""

from recordset.operators import keyed_write as W
from recordset.sources.layout import latest_version
from recordset.sources.store import scan_set
from recordset.streaming.sink import apply_batch, write_stream_to_set

SCHEMA = "key string, first string, n bigint"


def test_stream_into_set(spark, tmp_out):
    src, root = f"{tmp_out}/in", f"{tmp_out}/sets/people"
    # One file per input folder: it appears atomically, so each folder is one micro-batch.
    spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA).coalesce(1).write.parquet(f"{src}/1")
    spec = W.WriteSpec("people", mode="append", key_col="key", as_of=0)
    stream = spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
    q = write_stream_to_set(stream, root, spec, as_of=100, checkpoint_location=f"{tmp_out}/ckpt")
    try:
        q.processAllAvailable()
        spark.createDataFrame([("a", "z", 3), ("c", "w", 4)], SCHEMA).coalesce(1).write.parquet(f"{src}/2")
        q.processAllAvailable()
    finally:
        q.stop()
    n, _ = latest_version(spark, root)
    assert n == 2
    got = {r["__key"]: (r["first"], r["__generation"]) for r in scan_set(spark, root, as_of=100).collect()}
    assert got == {"a": ("z", 2), "b": ("y", 1), "c": ("w", 1)}
    # Replaying batch 1 (as after a crash before the stream checkpoint) changes nothing; another stream's batch 1 counts.
    replay = spark.createDataFrame([("a", "again", 9)], SCHEMA)
    _, m = latest_version(spark, root)
    (stream_id,) = m.batches
    assert m.batches[stream_id] == 1
    assert apply_batch(replay, 1, root, spec, 100, stream_id=stream_id) is False
    assert latest_version(spark, root)[0] == 2
    assert apply_batch(replay, 0, root, spec, 100, stream_id="other") is True
    assert scan_set(spark, root, as_of=100).where("__key = 'a'").first()["first"] == "again"
    assert latest_version(spark, root)[1].batches == {stream_id: 1, "other": 0}


def test_restarted_stream_goes_on(spark, tmp_out):
    src, root = f"{tmp_out}/in", f"{tmp_out}/sets/again"
    spec = W.WriteSpec("again", mode="append", key_col="key", as_of=0)
    for i in (1, 2):
        spark.createDataFrame([("a", f"x{i}", i)], SCHEMA).coalesce(1).write.parquet(f"{src}/{i}")
        q = write_stream_to_set(spark.readStream.schema(SCHEMA).parquet(f"{src}/*"), root, spec, 100, f"{tmp_out}/ckpt", {"availableNow": True})
        q.awaitTermination()
    r = scan_set(spark, root, as_of=100).first()
    assert r["first"] == "x2" and r["__generation"] == 2 and len(latest_version(spark, root)[1].batches) == 1


def test_stream_into_bucketed_set(spark, tmp_out):
    src, root = f"{tmp_out}/in", f"{tmp_out}/sets/bk"
    spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], SCHEMA).coalesce(1).write.parquet(f"{src}/1")
    spec = W.WriteSpec("bk", mode="append", key_col="key", as_of=0)
    stream = spark.readStream.schema(SCHEMA).parquet(f"{src}/*")
    q = write_stream_to_set(stream, root, spec, as_of=100, checkpoint_location=f"{tmp_out}/ckpt", buckets=4)
    try:
        q.processAllAvailable()
        spark.createDataFrame([("a", "z", 3)], SCHEMA).coalesce(1).write.parquet(f"{src}/2")
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["__key"]: (r["first"], r["__generation"]) for r in scan_set(spark, root, as_of=100).collect()}
    assert got == {"a": ("z", 2), "b": ("y", 1)}
    replay = spark.createDataFrame([("a", "again", 9)], SCHEMA)
    (stream_id,) = latest_version(spark, root)[1].batches
    assert apply_batch(replay, 1, root, spec, 100, buckets=4, stream_id=stream_id) is False
    assert scan_set(spark, root, as_of=100).where("__key = 'a'").first()["first"] == "z"
