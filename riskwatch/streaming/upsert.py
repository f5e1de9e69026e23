"""Structured Streaming hook for the re-runnable upsert sink.

The reference has no streaming operator; what it has is an append-safe
re-runnable sink. ``upsert_stream`` lets a stream of result batches (e.g. new
monthly cohorts) feed that sink through ``foreachBatch``: each micro-batch is
merged into the latest version (last wins per key), and the checkpoint gives
exactly-once progress across restarts. With ``partition_by`` a micro-batch rewrites
only the partitions it has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..sources.sinks import sink_upsert


def upsert_batch_writer(base: str, keys: Sequence[str], fmt: str = "parquet",
                        transform: Callable[[DataFrame], DataFrame] | None = None,
                        sequence: str | None = None, partition_by: str | None = None):
    """``foreachBatch`` function: optional transform, then upsert into ``base``."""
    def _write(batch: DataFrame, epoch_id: int) -> None:
        out = transform(batch) if transform is not None else batch
        if not out.isEmpty():
            sink_upsert(out, base, keys, fmt, sequence, partition_by)
    return _write


def upsert_stream(stream: DataFrame, base: str, keys: Sequence[str], checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  trigger_once: bool = True, sequence: str | None = None, partition_by: str | None = None):
    """Start a streaming query that upserts every micro-batch into ``base``."""
    w = (stream.writeStream.foreachBatch(upsert_batch_writer(base, keys, transform=transform, sequence=sequence,
                                                            partition_by=partition_by))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
