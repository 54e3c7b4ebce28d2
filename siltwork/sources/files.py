"""Text and CSV files, batch and stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltwork.operators.contracts import Contract

CORRUPT = "_corrupt_record"


def read_text(spark: SparkSession, path: str, line_separator: str = ".") -> DataFrame:
    """One row per piece of text between separators, column ``value``."""
    return spark.read.text(path, lineSep=line_separator)


def stream_text(
    spark: SparkSession, path: str, line_separator: str = ".", max_files_per_batch: int | None = None
) -> DataFrame:
    """The streaming twin of :func:`read_text`."""
    reader = spark.readStream.option("lineSep", line_separator)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.text(path)


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], contract: Contract, separator: str = ","
) -> DataFrame:
    """CSV with a header into the contract's types, all or nothing.

    A field that does not parse, or a row that breaks the contract, fails the
    load instead of being turned into nulls.
    """
    frame = (
        spark.read.schema(contract.schema())
        .option("header", True)
        .option("sep", separator)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(list(paths) if not isinstance(paths, str) else paths)
    )
    return contract.enforce(frame)


def read_csv_split(
    spark: SparkSession, paths: str | Sequence[str], contract: Contract, separator: str = ","
) -> tuple[DataFrame, DataFrame]:
    """CSV rows that keep the contract, and the others with their reasons.

    Every field is first read as text, so a bad number is reported under its
    own column and the original text is kept.
    """
    text = StructType([StructField(f.name, StringType()) for f in contract.fields])
    frame = (
        spark.read.schema(text.add(CORRUPT, StringType()))
        .option("header", True)
        .option("sep", separator)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(list(paths) if not isinstance(paths, str) else paths)
    )
    return contract.split(frame, extra=[(F.col(CORRUPT).isNotNull(), "row:malformed")])


def route_by_path(frame: DataFrame, routes: Mapping[str, str], default: str) -> DataFrame:
    """Name the target table of each row from the folder its file lies in.

    ``routes`` maps a path fragment to a table name; the first match wins.
    ``frame`` must come straight from a file reader.
    """
    path = F.col("_metadata.file_path")
    matches = (F.when(path.contains(fragment), name) for fragment, name in routes.items())
    return frame.select("*", F.coalesce(*matches, F.lit(default)).alias("target_table"))


def with_source_file(frame: DataFrame) -> DataFrame:
    return frame.select("*", F.col("_metadata.file_path").alias("source_file"))
