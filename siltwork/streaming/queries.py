"""Starting streams.

A stream is a source frame, the same transform a batch job uses, and a sink.
Every query needs a checkpoint, so a restart goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

EVERY = "30 seconds"

BatchSink = Callable[[DataFrame, int], None]


def start(
    frame: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    output_mode: str = "append",
    every: str | None = EVERY,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query that hands each micro-batch and its id to ``sink``.

    ``every=None`` reads what is there now and stops.
    """
    writer = frame.writeStream.foreachBatch(sink).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_available(frame: DataFrame, sink: BatchSink, checkpoint: str, output_mode: str = "append") -> None:
    """Process everything available now, then return."""
    query = start(frame, sink, checkpoint, output_mode, every=None)
    query.awaitTermination()
    failure = query.exception()
    if failure:
        raise failure
