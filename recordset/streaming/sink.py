"""Streaming keyed writes: a Structured Streaming query into a stored set.

Each micro-batch goes through the same per-record merge as a batch write. The
version it publishes names the stream and the batch, so a batch replayed after a failure (its
version published, the stream's own checkpoint not yet) is found and skipped: each is applied exactly
once. The stream is known by the id that its checkpoint keeps, so streams into one set do
not get in each other's way, and a restart goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from recordset.operators.bucketed_write import write_bucketed
from recordset.operators.keyed_write import WriteSpec

AsOf = int | Callable[[DataFrame, int], int]


def apply_batch(
    batch: DataFrame, batch_id: int, set_root: str, spec: WriteSpec, as_of: AsOf, buckets: int | None = None, stream_id: str | None = None
) -> bool:
    """Merge one micro-batch into the set; False when it was applied before."""
    spark = batch.sparkSession
    stream_id = stream_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream_id:
        raise ValueError("outside a streaming query stream_id is needed")
    when = as_of(batch, batch_id) if callable(as_of) else as_of
    return write_bucketed(spark, batch, set_root, replace(spec, as_of=when), buckets, (stream_id, batch_id)) is not None


def write_stream_to_set(
    stream: DataFrame,
    set_root: str,
    spec: WriteSpec,
    as_of: AsOf,
    checkpoint_location: str,
    trigger: dict | None = None,
    query_name: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Start a streaming query that keeps the set at ``set_root`` up to date.

    ``checkpoint_location`` must outlive the application: it keeps the stream's id and progress.
    """
    w = stream.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, set_root, spec, as_of, buckets)).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
