"""Starting a streaming query, waiting for it, and stopping it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def prepared(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> DataStreamWriter:
    """Set the checkpoint and the trigger: an interval such as `10 seconds`, or all available data, then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def run(writer: DataStreamWriter, timeout: float | None = None) -> StreamingQuery:
    """Run until the query ends or `timeout` seconds pass, then stop it; a failed query raises.

    Work cut off by the timeout is not lost: the next run from the same checkpoint takes it up again.
    """
    query = writer.start()
    try:
        query.awaitTermination(timeout) if timeout is not None else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    return query


def to_parquet(stream: DataFrame, path: str, checkpoint: str, every: str | None = None,
               timeout: float | None = None) -> StreamingQuery:
    """Append the stream to a Parquet directory, exactly once per checkpoint."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return run(prepared(writer, checkpoint, every), timeout)


def for_each_batch(stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str,
                   mode: str = "append", every: str | None = None, timeout: float | None = None) -> StreamingQuery:
    """Call `action(batch, batch_id)` per micro-batch. A batch may be replayed, so the action must be
    idempotent in its batch id."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(action)
    return run(prepared(writer, checkpoint, every), timeout)
