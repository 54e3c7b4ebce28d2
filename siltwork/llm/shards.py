"""Shards by jump consistent hashing: no ring table, and few rows move when shards are added."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.shipping import ship
from siltwork.operators.keys import PLACE, SLICE, place_in_order
from siltwork.shared import write_shared

MULTIPLIER = np.uint64(2862933555777941757)  # the constant of the published jump hash
ROW_BYTES = 8
BLOCK_BYTES = 256 * 1024**2


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key.  Every key jumps forward over shard counts until it leaves the range."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state))
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving].astype(np.int64)
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        drawn = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = np.floor((shard[moving] + 1) * (2.0**31 / drawn))
        moving = moving[ahead[moving] < shards]
    return shard.astype(np.int32)


def shard_of(shards: int):
    """Column function: a 64-bit integer key to its shard; a null key counts as 0."""

    @F.arrow_udf("int")
    def shard(keys: pa.Array) -> pa.Array:
        return pa.array(jump(pc.fill_null(keys, 0).to_numpy(zero_copy_only=False).view(np.uint64), shards))

    return shard


def shard_rows(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of each row: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The id and the shard count alone decide the shard, so equal ids share one;
    ``grown_shard`` is the shard with one more, either the same or the new one.
    Slots run from 0 without a gap in id order; rows of one id follow by
    checksum, size and place in the input.  A null id is hashed as 0; a null
    text has the checksum of an empty one and no bytes.  Extra columns are not read.

    Texts are read once.  What is sorted is one narrow row for each document.
    """
    ship(docs.sparkSession)
    text = F.coalesce(text_col, F.lit(""))
    key = F.col(id_col).cast("bigint")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(shards)(key).alias("shard"),
        shard_of(shards + 1)(key).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    narrow = write_shared(narrow, "shards")
    placed = place_in_order(narrow, ["shard", "doc_id", "text_crc32", "size", "_row"])
    # A row for each range partition and shard in it: its size follows the partition count.
    parts = placed.groupBy(SLICE, "shard").agg(F.min(PLACE).alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("shard").orderBy(SLICE)) - F.col("_rows")
    starts = parts.select(SLICE, "shard", (before - F.col("_first")).alias("_shift"))
    return placed.join(starts, [SLICE, "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col(PLACE) + F.col("_shift")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> None:
    """Write whole rows below ``path/__shard=N``, a shard in as many files as its bytes need.

    Rows of a shard are dealt over blocks by a hash of the row, so no task holds a whole shard.
    """
    ship(docs.sparkSession)
    placed = docs.withColumn("__shard", shard_of(shards)(F.col(id_col).cast("bigint")))
    text_bytes = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in docs.columns), F.lit(0))
    total = docs.agg(F.sum(text_bytes.cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-total // (shards * block_bytes)))
    block = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(blocks))
    placed.repartition(shards * blocks, "__shard", block).write.partitionBy("__shard").parquet(path)
