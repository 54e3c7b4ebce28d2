"""Sinks for micro-batches.

Each writes under the batch id and overwrites, so a batch that is replayed
after a failure leaves the same files as the first try.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.published import KEPT_VERSIONS, Published, publish
from siltwork.sinks.files import landing_path, write_csv, write_json, write_parquet, write_partitioned
from siltwork.streaming.queries import BatchSink

BATCH_ID = "batch_id"
CYCLE = 10


def replace_sink(path: str) -> BatchSink:
    """Complete mode: the folder always holds the latest full result."""
    return lambda batch, batch_id: write_parquet(batch, path)


def replace_table_sink(table: str, path: str | None = None, reader: SparkSession | None = None) -> BatchSink:
    """Complete mode into a catalog table, whose readers see the result before a batch or after it.

    ``path`` is the folder of its versions, see :func:`siltwork.published.publish`.  Micro-batches run in a session of their own; ``reader`` is a session whose
    cached file list of the table must be dropped after each batch.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        publish(batch, table, path)
        if reader is not None:
            reader.catalog.refreshTable(table)

    return sink


def staged_sink(path: str) -> BatchSink:
    """Append as one ``batch_id=N`` partition per batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_partitioned(batch.withColumn(BATCH_ID, F.lit(batch_id)), path, [BATCH_ID])

    return sink


def json_sink(base: str, day: dt.date) -> BatchSink:
    return lambda batch, batch_id: write_json(batch, landing_path(base, day, batch_id, "json"))


def csv_sink(base: str, day: dt.date) -> BatchSink:
    return lambda batch, batch_id: write_csv(batch, landing_path(base, day, batch_id, "csv"))


def parquet_sink(base: str, day: dt.date) -> BatchSink:
    return lambda batch, batch_id: write_parquet(batch, landing_path(base, day, batch_id, "parquet"))


def route_of(batch_id: int) -> str:
    """Sink of a batch: of each ten, one to JSON, CSV and Parquet each, the rest to the table.

    It depends on the batch id alone, so a replay goes to the same sink.
    """
    return {0: "json", 1: "csv", 2: "parquet"}.get(batch_id % CYCLE, "table")


def fan_out(sinks: Mapping[str, BatchSink], choose: Callable[[int], str] = route_of) -> BatchSink:
    """Send each batch to one of several sinks."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        sinks[choose(batch_id)](batch, batch_id)

    return sink


def to_all(*sinks: BatchSink) -> BatchSink:
    """Send each batch to every sink, computing it once."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for target in sinks:
                target(kept, batch_id)
        finally:
            kept.unpersist()

    return sink


def published_sink(path: str, part: Column | None = None, append: bool = False, keep: int = KEPT_VERSIONS) -> BatchSink:
    """Each batch a version of a published table: the whole result, or with ``append`` what it adds.

    The batch id is committed with the rows.  A batch that is replayed finds its id there and changes nothing, so
    rows are appended once, whatever step the first try came to.  ``keep`` versions stay; see
    :meth:`Published.expire`.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        table = Published(batch.sparkSession, path)
        held = table.manifest()
        if held is not None and batch_id <= held.notes.get(BATCH_ID, -1):
            return
        if append:
            table.append(batch, part, **{BATCH_ID: batch_id})
        else:
            table.replace(batch, **{BATCH_ID: batch_id})
        table.expire(keep)

    return sink
