"""Spark session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that hold for any input size.  Partition counts are left to adaptive
# execution: it starts from spark.sql.shuffle.partitions and merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "30s",
    # Running counts keep one state row per distinct key; RocksDB holds them
    # on executor disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


# Shuffled bytes one task should take, and the fewest partitions worth starting
# from.  Smaller parts would make the driver's block tables the limit at 100 TB.
BYTES_PER_PARTITION = 1024**3
FEWEST_PARTITIONS = 200


def partitions_for(input_bytes: int) -> int:
    """Shuffle partitions for the largest shuffled input: 100 TB gives about 93,000.

    Start a job's session with this value; adaptive execution merges what a
    smaller shuffle of the same job does not need.
    """
    return max(FEWEST_PARTITIONS, -(-input_bytes // BYTES_PER_PARTITION))


def build_session(app_name: str = "siltwork", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
