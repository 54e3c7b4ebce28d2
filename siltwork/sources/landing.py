"""Landing folders: every new file exactly once, then archived by date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltwork.operators.keyed import KeyedTable
from siltwork.shared import write_shared


def archive_folder(base: str, day: dt.date) -> str:
    """``base/date_YYYY-MM-DD``."""
    return f"{base.rstrip('/')}/date_{day.isoformat()}"


def stream_landing(
    spark: SparkSession,
    pattern: str,
    schema: StructType,
    archive_to: str | None = None,
    file_format: str = "csv",
    max_files_per_batch: int | None = None,
    **options: object,
) -> DataFrame:
    """Files matching ``pattern`` as a stream.

    The query's checkpoint records which files were read.  With ``archive_to``
    a file moves there once a later batch has committed after its own.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.options(**options).load(pattern)


class LandedFiles:
    """A manifest of the files taken from a landing folder: path, size, time of change and digest.

    A stream's checkpoint knows paths alone: a file that lands again under its old name, or changed, is not seen, and a
    copy under a new name is read twice.  Here a file is told by what it holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.held = spark, KeyedTable(spark, path, ["path"])
        self.schema = "path string, length bigint, modified timestamp, digest string, state string"

    def look(self, pattern: str) -> DataFrame:
        """Files that are not as the manifest has them, with their ``state``.

        ``new`` has a digest nobody has seen, ``changed`` too, under a path that had another; ``copy`` holds what an
        earlier file held, or a file of this look with a smaller path; ``touched`` is the same file with a new time.
        Only paths, sizes and times of known files are read; others are read whole, by the tasks, to be digested, and
        their paths come to the driver, as with any list of files to read.
        """
        listed = self.spark.read.format("binaryFile").load(pattern).select("path", "length", F.col("modificationTime").alias("modified"))
        known = self.known()
        other = listed.join(known.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
        paths = [r["path"] for r in other.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        content = self.spark.read.format("binaryFile").load(paths)
        seen = content.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("digest"))
        seen = write_shared(seen, "digests")
        before = known.select("path", F.col("digest").alias("_own"))
        digests = known.select("digest").distinct().withColumn("_known", F.lit(True))
        first = seen.groupBy("digest").agg(F.min("path").alias("_first"))
        joined = seen.join(before, "path", "left").join(digests, "digest", "left").join(first, "digest")
        state = (
            F.when(F.col("_own") == F.col("digest"), "touched")
            .when(F.col("_known") | (F.col("path") != F.col("_first")), "copy")
            .when(F.col("_own").isNotNull(), "changed")
            .otherwise("new")
        )
        return joined.select("path", "length", "modified", "digest", state.alias("state"))

    def known(self) -> DataFrame:
        self.held.open(self.spark.createDataFrame([], self.schema).schema)
        return self.held.read()

    def take(self, looked: DataFrame) -> None:
        """Note the files of a look as taken; do so once what they hold is committed."""
        self.known()
        self.held.upsert(looked)


def read_landed(spark: SparkSession, looked: DataFrame, schema: StructType, **options: object) -> DataFrame:
    """Rows of the new and changed CSV files of a look."""
    paths = [r["path"] for r in looked.where(F.col("state").isin("new", "changed")).select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").options(**options).csv(paths)
