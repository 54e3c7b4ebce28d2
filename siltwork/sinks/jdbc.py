"""JDBC writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

DEFAULT_BATCH = 10_000


def sink_options(
    url: str, table: str, batch_size: int = DEFAULT_BATCH, keep_definition: bool = False,
    num_partitions: int | None = None, properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC write; ``num_partitions`` bounds the open connections."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    if keep_definition:
        options["truncate"] = "true"
    if num_partitions:
        options["numPartitions"] = str(num_partitions)
    return options


def replace_rows(df: DataFrame, url: str, table: str, **settings: object) -> None:
    """Overwrite by truncating, so the table keeps its types and constraints."""
    settings.setdefault("keep_definition", True)
    df.write.format("jdbc").options(**sink_options(url, table, **settings)).mode("overwrite").save()


def insert_rows(df: DataFrame, url: str, table: str, **settings: object) -> None:
    """Append.  A replayed micro-batch appends again: stream into a staging
    table keyed by batch id, or use the file sinks."""
    df.write.format("jdbc").options(**sink_options(url, table, **settings)).mode("append").save()
