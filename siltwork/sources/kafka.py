"""Message topics: the stream and the bounded read.

Both give a DataFrame with a binary ``value``; everything after that point
takes any such frame, so a file or rate stream can stand in for the broker.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str, topic: str, starting: str = "earliest", ending: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    if not servers or not topic:
        raise ValueError("servers and topic must be given")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if ending is not None:
        options["endingOffsets"] = ending
    return {**options, **(extra or {})}


def stream_topic(spark: SparkSession, servers: str, topic: str, **settings: object) -> DataFrame:
    """Unbounded read; the query's checkpoint holds the offsets."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **settings)).load()


def read_topic(spark: SparkSession, servers: str, topic: str, **settings: object) -> DataFrame:
    """Everything in the topic now, read in parallel by topic partition."""
    settings.setdefault("ending", "latest")
    return spark.read.format("kafka").options(**topic_options(servers, topic, **settings)).load()
