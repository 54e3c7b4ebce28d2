"""File and catalog-table writers.

Each keeps the partitioning it is given: output files are written by all tasks
in parallel, and ``max_records_per_file`` bounds their size where that matters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

CSV_SEPARATOR = "|"


def landing_path(base: str, day: dt.date, batch_id: int, file_format: str) -> str:
    """``base/input_YYYY-MM-DD/batch_N.format``: one folder per micro-batch."""
    return f"{base.rstrip('/')}/input_{day.isoformat()}/batch_{batch_id}.{file_format}"


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", separator: str = CSV_SEPARATOR) -> None:
    df.write.mode(mode).option("header", True).option("sep", separator).csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Parquet by partition columns; a rerun replaces only the partitions it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a managed table, or an external one at ``path``."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append_rows(df: DataFrame, target: str, file_format: str = "parquet", **options: str) -> None:
    """Append through any connector that takes a save path or table in its options."""
    writer = df.write.format(file_format).mode("append").options(**options)
    writer.save(target) if target else writer.save()


def require_rows(df: DataFrame, name: str = "input") -> DataFrame:
    """``df``, or an error when it is empty; only the first row is computed."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with a row count that its next action fills in, without a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("amount")), seen
