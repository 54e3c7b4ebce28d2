"""New users: nested API records to a flat, typed, keyed stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltwork.functions.messages import decode_messages, message_id, street_address
from siltwork.plans.tables import NEW_USERS
from siltwork.streaming.queries import BatchSink

RECORD = (
    StructType()
    .add("name", StructType().add("first", "string").add("last", "string"))
    .add("gender", "string")
    .add(
        "location",
        StructType()
        .add("street", StructType().add("number", "integer").add("name", "string"))
        .add("city", "string")
        .add("state", "string")
        .add("country", "string")
        .add("postcode", "string"),
    )
    .add("email", "string")
    .add("login", StructType().add("username", "string"))
    .add("dob", StructType().add("date", "string"))
    .add("registered", StructType().add("date", "string"))
    .add("phone", "string")
    .add("picture", StructType().add("medium", "string"))
)


def flatten_records(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """One flat row per nested record, on a batch or a stream."""
    record = decode_messages(messages, RECORD, value_col)
    return record.select(
        F.col("name.first").alias("first_name"),
        F.col("name.last").alias("last_name"),
        "gender",
        street_address(F.col("location")).alias("address"),
        F.col("location.postcode").alias("post_code"),
        "email",
        F.col("login.username").alias("username"),
        F.col("dob.date").alias("dob"),
        F.col("registered.date").alias("registered_date"),
        "phone",
        F.col("picture.medium").alias("picture"),
    )


def decode_users(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed rows from flat JSON messages, with an id made from the message where none is sent."""
    users = decode_messages(messages, NEW_USERS.schema(), value_col, keep=[value_col])
    return users.withColumn("id", F.coalesce("id", message_id(F.col(value_col)))).drop(value_col)


def keyed_append_sink(target: str, file_format: str = "parquet", **options: str) -> BatchSink:
    """Append micro-batches through a connector whose table is keyed.

    Such a table (Cassandra, for one) replaces a row with the same key, which
    makes a replayed batch harmless: the key comes with, or from, the message.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(file_format).mode("append").options(**options).save(target)

    return sink
