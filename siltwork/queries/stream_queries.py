"""Streams over files derived from the given tables, run until nothing is left."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.messages import encode_rows
from siltwork.plans import clicks
from siltwork.plans.tables import CLICK_MESSAGE
from siltwork.plans.users import decode_users, flatten_records, keyed_append_sink
from siltwork.queries import inputs
from siltwork.queries.click_queries import CLICK_COLUMNS
from siltwork.queries.inputs import CLICKS_SQL
from siltwork.queries.registry import query, table
from siltwork.queries.table_queries import nested_users
from siltwork.shared import shared_path
from siltwork.sinks.files import CSV_SEPARATOR
from siltwork.streaming.batches import replace_sink, staged_sink, to_all
from siltwork.streaming.queries import run_available

DAY = dt.date(2024, 9, 4)
BATCHES = 12


def _message_stream(messages: DataFrame, label: str, parts: int, per_batch: int = 1) -> DataFrame:
    """Messages written as files and read as a stream, a few files to a batch."""
    spark = messages.sparkSession
    path = shared_path(spark, label)
    messages.select("value").repartition(parts).write.parquet(path)
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", per_batch).parquet(path)


@query(f"""WITH {CLICKS_SQL}
SELECT {CLICK_COLUMNS} FROM clicks WHERE is_json
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM clicks WHERE NOT is_json""")
def fanout_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded clicks, each micro-batch in the folder its id selects, all read back."""
    base = shared_path(spark, "clicks")
    stream = _message_stream(inputs.click_messages(spark, folder), "click-messages", BATCHES)
    clicks.start_landing(stream, base, DAY, f"{base}/checkpoint", every=None).awaitTermination()
    schema = CLICK_MESSAGE.schema()
    day = f"{base}/input_{DAY.isoformat()}"
    reader = spark.read.schema(schema)
    landed = [
        reader.json(f"{day}/batch_*.json"),
        spark.read.schema(schema).option("header", True).option("sep", CSV_SEPARATOR).csv(f"{day}/batch_*.csv"),
        spark.read.schema(schema).parquet(f"{day}/batch_*.parquet"),
        spark.read.parquet(f"{base}/table").select(*schema.names),
    ]
    together = landed[0]
    for frame in landed[1:]:
        together = together.unionByName(frame)
    return together.withColumn("activity_time", F.col("activity_time").cast("timestamp_ntz"))


@query("""
SELECT split_part(c_name, '#', 2) AS last_name, 'user' || c_custkey AS username,
       c_custkey || ' Main Street, ' || n_name || ', ' || r_name || ', Earth' AS address, true AS has_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def user_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Nested records to flat messages to typed rows in an appended table."""
    base = shared_path(spark, "users")
    flat = encode_rows(flatten_records(_message_stream(nested_users(spark, folder), "user-records", 4, per_batch=2)))
    run_available(decode_users(flat), keyed_append_sink(f"{base}/created"), f"{base}/checkpoint")
    created = spark.read.parquet(f"{base}/created")
    return created.select("last_name", "username", "address", F.col("id").isNotNull().alias("has_id"))


@query("SELECT event_type, COUNT(*) AS count FROM events GROUP BY ALL")
def running_counts_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Counts kept over two runs of one query on the same checkpoint.

    The second half of the files arrives after the first run has ended.
    """
    base = shared_path(spark, "running")
    events = table(spark, folder, "events").select("event_id", "event_type")
    for half in (0, 1):
        events.where(f"event_id % 2 = {half}").write.mode("append").parquet(f"{base}/in")
        counts = spark.readStream.schema(events.schema).parquet(f"{base}/in").groupBy("event_type").count()
        run_available(counts, replace_sink(f"{base}/out"), f"{base}/checkpoint", output_mode="complete")
    return spark.read.parquet(f"{base}/out")


@query("""
SELECT event_type, COUNT(*) AS amount, 'staged' AS sink FROM events GROUP BY ALL
UNION ALL SELECT event_type, COUNT(*), 'appended' FROM events GROUP BY ALL""")
def two_sink_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Each micro-batch computed once and sent to two sinks."""
    base = shared_path(spark, "two-sinks")
    messages = encode_rows(table(spark, folder, "events").select("event_type")).select(F.col("value").cast("binary"))
    stream = _message_stream(messages, "event-messages", 4, per_batch=2)
    typed = stream.select(F.from_json(F.col("value").cast("string"), "event_type string")["event_type"].alias("event_type"))
    run_available(typed, to_all(staged_sink(f"{base}/a"), staged_sink(f"{base}/b")), f"{base}/checkpoint")
    sides = [
        spark.read.parquet(f"{base}/{folder_name}").groupBy("event_type").agg(F.count("*").alias("amount"))
        .withColumn("sink", F.lit(label))
        for folder_name, label in (("a", "staged"), ("b", "appended"))
    ]
    return sides[0].unionByName(sides[1])
