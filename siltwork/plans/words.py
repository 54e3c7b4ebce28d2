"""Word count: one transform for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltwork.functions.text import has_prefix, is_word, normal_word, words
from siltwork.operators.reports import total_where
from siltwork.published import publish
from siltwork.sources.files import read_text, stream_text
from siltwork.streaming.batches import replace_table_sink
from siltwork.streaming.queries import start


def sentences(df: DataFrame, text_col: str, separator: str = r"\.") -> DataFrame:
    """Texts cut at dots, as the text reader cuts files; column ``value``."""
    return df.select(words(F.col(text_col), separator).alias("value"))


def word_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Occurrences of each normalised word, on a batch or a stream."""
    found = lines.select(words(F.col(value_col)).alias("word")).select(normal_word(F.col("word")).alias("word"))
    return found.where(is_word(F.col("word"))).groupBy("word").count()


def occurrences_with_prefix(counts: DataFrame, prefix: str) -> DataFrame:
    return total_where(counts, has_prefix(F.col("word"), prefix), "count")


def count_files(spark: SparkSession, path: str, table: str) -> None:
    """Batch: count the words of all files and replace the table."""
    publish(word_counts(read_text(spark, path)), table)


def count_stream(
    spark: SparkSession, path: str, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Stream: keep running counts over restarts and replace the table each batch."""
    counts = word_counts(stream_text(spark, path))
    return start(counts, replace_table_sink(table, reader=spark), checkpoint, output_mode="complete", every=every)
