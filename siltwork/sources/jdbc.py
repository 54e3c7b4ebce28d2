"""JDBC tables, read in parallel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.dates import on_day


def scan_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan; the four partition settings go together."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    ranged = (partition_column, lower, upper, num_partitions)
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError("partition_column, lower, upper and num_partitions go together")
        options.update(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(num_partitions),
        )
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str] | None = None,
    properties: Mapping[str, str] | None = None,
    **ranged: object,
) -> DataFrame:
    """Scan a table with one task per range of a column, or per predicate.

    Filters and column choices made on the result are pushed to the database.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties or {}))
    return spark.read.format("jdbc").options(**scan_options(url, table, properties=properties, **ranged)).load()


def uploaded_on(
    rows: DataFrame,
    day: dt.date | None = None,
    status_col: str = "status",
    created_col: str = "created_at",
    status: str = "uploaded",
) -> DataFrame:
    """Rows still waiting for processing, of one day or of any day."""
    waiting = rows.where(F.col(status_col) == status)
    return waiting if day is None else waiting.where(on_day(F.col(created_col), day))


def ready_on(rows: DataFrame, day: dt.date, created_col: str = "created") -> DataFrame:
    """One row, one boolean: is there any row of that day.

    The limit stops the scan at the first hit.
    """
    hits = rows.where(on_day(F.col(created_col), day)).select(F.lit(1).alias("hit")).limit(1)
    return hits.agg((F.count("hit") > 0).alias("ready"))
