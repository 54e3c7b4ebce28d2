"""The state of a running count: looked at, and carried over to a query with other partitions.

The number of partitions of a stateful query is fixed by its first run.  To change it, the state is read as a table
and becomes the first rows of a new query: counts are sums, so rows counted so far go in as one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AMOUNT = "count"


def counts_in_state(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """The running counts a query's checkpoint holds after its last batch: ``keys`` and ``count``."""
    state = spark.read.format("statestore").load(checkpoint)
    held = state.schema["value"].dataType.names
    return state.select(*(F.col("key")[k].alias(k) for k in keys), F.col("value")[held[0]].cast("long").alias(AMOUNT))


def seed_counts(spark: SparkSession, checkpoint: str, keys: Sequence[str], seeds: str) -> None:
    """Write a stopped query's counts below ``seeds``, once: the folder a successor begins with."""
    counts_in_state(spark, checkpoint, keys).write.mode("errorifexists").parquet(seeds)


def carried_counts(rows: DataFrame, keys: Sequence[str], seeds: str) -> DataFrame:
    """Running counts of a stream of rows that go on from ``seeds``.

    Start it with a new checkpoint; ``spark.sql.shuffle.partitions`` at its first run sets its partitions.
    """
    spark = rows.sparkSession
    schema = rows.select(*keys).schema.add(AMOUNT, "long")
    before = spark.readStream.schema(schema).parquet(seeds)
    each = rows.select(*keys, F.lit(1).cast("long").alias(AMOUNT))
    return before.unionByName(each).groupBy(*keys).agg(F.sum(AMOUNT).alias(AMOUNT))
