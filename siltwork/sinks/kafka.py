"""Message topic writers: rows as JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from siltwork.functions.messages import encode_rows

# Delivery settings of the producer.
PRODUCER = {
    "kafka.acks": "1",
    "kafka.batch.size": str(32 * 1024),
    "kafka.linger.ms": "5",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "300",
}


def producer_options(servers: str, topic: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    if not servers or not topic:
        raise ValueError("servers and topic must be given")
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER, **(extra or {})}


def write_topic(df: DataFrame, servers: str, topic: str, key_col: str | None = None, **extra: str) -> None:
    """Send every row of a batch (or micro-batch) as one JSON message."""
    encode_rows(df, key_col).write.format("kafka").options(**producer_options(servers, topic, extra)).save()
