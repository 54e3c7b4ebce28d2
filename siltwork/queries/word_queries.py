"""Word counts over documents: in place, over text files, and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltwork.plans import words
from siltwork.published import Published
from siltwork.queries.registry import query, table
from siltwork.shared import shared_path
from siltwork.sources.files import read_text, stream_text
from siltwork.streaming.batches import published_sink
from siltwork.streaming.queries import run_available

COUNTS = """
WITH s AS (SELECT unnest(string_split(text, '.')) AS value FROM documents),
     w AS (SELECT lower(trim(unnest(string_split(value, ' ')), ' ')) AS word FROM s),
     counts AS (SELECT word, COUNT(*) AS count FROM w WHERE regexp_matches(word, '[a-z]') GROUP BY word)
"""


def _text_files(spark: SparkSession, folder: str) -> str:
    """The documents as text files whose records end in a dot."""
    path = shared_path(spark, "texts")
    table(spark, folder, "documents").select("text").write.text(path, lineSep=".")
    return path


@query(f"{COUNTS} SELECT * FROM counts")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(words.sentences(table(spark, folder, "documents"), "text"))


@query(f"{COUNTS} SELECT CAST(SUM(count) AS BIGINT) AS total FROM counts WHERE substr(word, 1, 1) = 's'")
def words_with_s(spark: SparkSession, folder: str) -> DataFrame:
    return words.occurrences_with_prefix(word_count(spark, folder), "s")


@query(f"{COUNTS} SELECT * FROM counts")
def word_count_files(spark: SparkSession, folder: str) -> DataFrame:
    return words.word_counts(read_text(spark, _text_files(spark, folder)))


@query(f"{COUNTS} SELECT * FROM counts")
def word_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Running counts over the text files, in several micro-batches, each published as a version."""
    counts = words.word_counts(stream_text(spark, _text_files(spark, folder)))
    out = shared_path(spark, "word-counts")
    run_available(counts, published_sink(out), shared_path(spark, "checkpoint"), output_mode="complete")
    return Published(spark, out).read()
