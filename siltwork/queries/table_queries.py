"""Single operators over the given tables: casts, filters, shaping, functions, sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.dates import age_in_years, from_epoch, on_day, stamp_text
from siltwork.functions.messages import decode_messages
from siltwork.functions.money import amount, line_total, total_differs
from siltwork.functions.network import ipv4_number
from siltwork.functions.people import parse_address
from siltwork.functions.text import has_prefix, is_word, joined, part
from siltwork.operators import reports
from siltwork.operators.columns import lift_fields, order_by_list, repair_types, shape, union_renamed
from siltwork.operators.keys import best_per_key
from siltwork.plans.users import RECORD, flatten_records
from siltwork.queries.registry import query, table
from siltwork.shared import shared_path, write_shared
from siltwork.sinks import files

AS_OF = dt.date(2024, 6, 15)


@query("""
SELECT p_partkey, TRY_CAST(regexp_replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_number,
       TRY_CAST(CASE WHEN p_size % 4 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS INTEGER) AS size_number,
       TRY_CAST(CASE WHEN p_size % 5 = 0 THEN 'soon' ELSE '2024-01-02 03:04:05' END AS TIMESTAMP) AS stamp
FROM part""")
def type_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns to their types; what does not fit becomes null."""
    text = table(spark, folder, "part").selectExpr(
        "p_partkey",
        "replace(p_brand, 'Brand#', '') AS brand_number",
        "CASE WHEN p_size % 4 = 0 THEN p_name ELSE CAST(p_size AS STRING) END AS size_number",
        "CASE WHEN p_size % 5 = 0 THEN 'soon' ELSE '2024-01-02 03:04:05' END AS stamp",
    )
    return repair_types(text, {"brand_number": "int", "size_number": "int", "stamp": "timestamp_ntz"})


@query("SELECT s_name AS supplier, s_suppkey AS id, s_nationkey AS nation FROM supplier")
def columns_shaped(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    names = {"s_name": "supplier", "s_suppkey": "id", "s_nationkey": "nation"}
    return shape(suppliers, rename=names, drop=("s_acctbal", "no_such_column"), order=("supplier", "id"))


ADDRESSED_SQL = """
WITH addressed AS (
  SELECT c_custkey, CASE c_custkey % 4
           WHEN 0 THEN c_name || ', Flat ' || c_custkey || ', ' || n_name || ', ' || r_name
           WHEN 1 THEN c_name || ',' || n_name || ',' || r_name
           WHEN 2 THEN n_name || ', ' || r_name END AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), pieces AS (SELECT *, string_split(address, ',') AS p FROM addressed)"""


@query(f"""{ADDRESSED_SQL}
SELECT c_custkey,
       CASE WHEN address IS NULL THEN NULL WHEN len(p) IN (3, 4) THEN trim(p[1], ' ') ELSE '' END AS street1,
       CASE WHEN address IS NULL THEN NULL WHEN len(p) = 4 THEN trim(p[2], ' ') ELSE '' END AS street2,
       CASE WHEN address IS NULL THEN NULL WHEN len(p) IN (3, 4) THEN trim(p[len(p) - 1], ' ') ELSE '' END AS city,
       CASE WHEN address IS NULL THEN NULL WHEN len(p) IN (3, 4) THEN trim(p[len(p)], ' ') ELSE '' END AS country
FROM pieces""")
def address_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of four, three and two parts, and none at all."""
    customers = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    addressed = customers.selectExpr(
        "c_custkey",
        """CASE c_custkey % 4 WHEN 0 THEN concat(c_name, ', Flat ', c_custkey, ', ', n_name, ', ', r_name)
                              WHEN 1 THEN concat(c_name, ',', n_name, ',', r_name)
                              WHEN 2 THEN concat(n_name, ', ', r_name) END AS address""",
    )
    parsed = addressed.select("c_custkey", parse_address(F.col("address")).alias("place"))
    return lift_fields(parsed, "place", ("street1", "street2", "city", "country"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS total,
       CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))
         <> CAST(l_extendedprice AS DECIMAL(10,2)) AS was_repaired
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def line_total_repair(spark: SparkSession, folder: str) -> DataFrame:
    sold = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
    quantity, price = F.col("l_quantity").cast("int"), amount(F.col("p_retailprice"), "decimal(10,2)")
    stored = amount(F.col("l_extendedprice"), "decimal(10,2)")
    return sold.select(
        "l_orderkey", "l_linenumber", "l_partkey", line_total(quantity, price).alias("total"),
        total_differs(quantity, price, stored).alias("was_repaired"),
    )


@query("""
SELECT o_orderkey,
       CAST(round((12 * (2024 - year(o_orderdate)) + (6 - month(o_orderdate))
         + CASE WHEN day(o_orderdate) = 15 THEN 0 ELSE (15 - day(o_orderdate)) / 31.0 END) / 12) AS INTEGER) AS age,
       CAST(floor((12 * (2024 - year(o_orderdate)) + (6 - month(o_orderdate))
         + CASE WHEN day(o_orderdate) = 15 THEN 0 ELSE (15 - day(o_orderdate)) / 31.0 END) / 12) AS INTEGER) AS full_years
FROM orders""")
def age_years(spark: SparkSession, folder: str) -> DataFrame:
    """Rounded and completed years since each order."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        age_in_years(F.col("o_orderdate"), AS_OF).alias("age"),
        age_in_years(F.col("o_orderdate"), AS_OF, floor=True).alias("full_years"),
    )


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def ts_format(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", stamp_text(F.col("ts")).alias("stamp"))


@query("SELECT event_id, make_timestamp((1700000000 + event_id) * 1000000) AS stamp FROM events")
def epoch_seconds(spark: SparkSession, folder: str) -> DataFrame:
    seconds = from_epoch(F.lit(1700000000) + F.col("event_id"))
    return table(spark, folder, "events").select("event_id", seconds.cast("timestamp_ntz").alias("stamp"))


@query("""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hours, CAST(year(ts) AS INTEGER) AS years,
       CAST(month(ts) AS INTEGER) AS month, CAST(ts AS DATE) AS date
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""")
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    day = table(spark, folder, "events").where(on_day(F.col("ts"), dt.date(2024, 1, 10)))
    ts = F.col("ts")
    return day.select(
        "event_id", F.hour(ts).alias("hours"), F.year(ts).alias("years"), F.month(ts).alias("month"),
        F.to_date(ts).alias("date"),
    )


@query("""
SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '/')[9] AS ninth,
       concat_ws(' ', CASE WHEN page_id % 2 = 0 THEN 'even' END, CAST(page_id AS VARCHAR)) AS label
FROM pages""")
def split_and_concat(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of a text, null past its end, and a concatenation that skips nulls."""
    even = F.when(F.col("page_id") % 2 == 0, "even")
    return table(spark, folder, "pages").select(
        "page_id", part(F.col("url"), "/", 2).alias("host"), part(F.col("url"), "/", 8).alias("ninth"),
        joined(" ", even, F.col("page_id").cast("string")).alias("label"),
    )


@query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 1000 AND 200000 AND o_orderkey % 2 = 0""")
def filtered_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.where(
        (F.col("o_orderstatus") == "F") & F.col("o_totalprice").between(1000, 200000) & (F.col("o_orderkey") % 2 == 0)
    ).select("o_orderkey", "o_totalprice")


@query("""
SELECT conv_id, turn, substr(text, 1, 1) = 'S' AS starts_with_s FROM conversations
WHERE text IS NOT NULL AND regexp_matches(text, '[a-z]')""")
def worded_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").where(is_word(F.col("text")))
    return turns.select("conv_id", "turn", has_prefix(F.col("text"), "S").alias("starts_with_s"))


@query("""
SELECT event_id,
       TRY_CAST(string_split(address, '.')[1] AS BIGINT) * 16777216 + TRY_CAST(string_split(address, '.')[2] AS BIGINT) * 65536
       + TRY_CAST(string_split(address, '.')[3] AS BIGINT) * 256 + TRY_CAST(string_split(address, '.')[4] AS BIGINT) AS number
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'no address'
        ELSE (event_id % 256) || '.' || (event_id % 200) || '.' || (event_id % 7) || '.' || (event_id % 251) END AS address
      FROM events)""")
def ip_numbers(spark: SparkSession, folder: str) -> DataFrame:
    address = F.expr(
        """CASE WHEN event_id % 10 = 0 THEN 'no address'
           ELSE concat_ws('.', event_id % 256, event_id % 200, event_id % 7, event_id % 251) END"""
    )
    return table(spark, folder, "events").select("event_id", ipv4_number(address).alias("number"))


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("""
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""")
def first_order_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    """One row per key by an explicit order."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return best_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], latest=False)


@query("SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier")
def names_together(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    suppliers = table(spark, folder, "supplier").select("s_name", "s_nationkey")
    return union_renamed(customers, suppliers, {"s_name": "name", "s_nationkey": "nation"})


@query("""
SELECT word_group, COUNT(word_group) AS amount
FROM (SELECT CASE WHEN p_size > 25 THEN p_type END AS word_group FROM part) GROUP BY ALL""")
def null_group_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The group without a value counts 0."""
    grouped = table(spark, folder, "part").selectExpr("CASE WHEN p_size > 25 THEN p_type END AS word_group")
    return reports.count_by(grouped, ["word_group"])


@query("""
SELECT o_orderpriority, o_orderstatus, COUNT(*) AS amount, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders GROUP BY ALL""")
def status_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Two keys, two aggregates, sorted by an explicit order of values."""
    orders = table(spark, folder, "orders").withColumn("price", amount(F.col("o_totalprice")))
    totals = orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count("*").alias("amount"), F.sum("price").alias("total")
    )
    return totals.orderBy(order_by_list(F.col("o_orderstatus"), ["O", "F"]), "o_orderpriority")


@query("SELECT COUNT(*) AS amount FROM lineitem")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("amount"))


@query("SELECT COUNT(*) AS written, COUNT(*) AS observed FROM orders")
def observed_count(spark: SparkSession, folder: str) -> DataFrame:
    """The count seen while a table was written, beside the count of what was written."""
    orders, seen = files.counted(table(spark, folder, "orders"))
    written = write_shared(orders, "observed")
    return written.agg(F.count(F.lit(1)).alias("written"), F.lit(seen.get["amount"]).cast("bigint").alias("observed"))


@query("""
SELECT split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, c_mktsegment AS gender,
       c_custkey || ' Main Street, ' || n_name || ', ' || r_name || ', Earth' AS address,
       CAST(10000 + c_custkey AS VARCHAR) AS post_code, 'user' || c_custkey || '@example.com' AS email,
       'user' || c_custkey AS username, '1990-01-01' AS dob, '2020-01-01' AS registered_date,
       '+' || c_custkey AS phone, 'https://example.com/' || c_custkey || '.png' AS picture
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def nested_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_records(nested_users(spark, folder))


def nested_users(spark: SparkSession, folder: str) -> DataFrame:
    """One nested user record per customer, as message bytes."""
    customers = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    record = F.expr("""to_json(named_struct(
        'name', named_struct('first', split_part(c_name, '#', 1), 'last', split_part(c_name, '#', 2)),
        'gender', c_mktsegment,
        'location', named_struct('street', named_struct('number', c_custkey, 'name', 'Main Street'), 'city', n_name,
                                 'state', r_name, 'country', 'Earth', 'postcode', 10000 + c_custkey),
        'email', concat('user', c_custkey, '@example.com'),
        'login', named_struct('username', concat('user', c_custkey)),
        'dob', named_struct('date', '1990-01-01'), 'registered', named_struct('date', '2020-01-01'),
        'phone', concat('+', c_custkey),
        'picture', named_struct('medium', concat('https://example.com/', c_custkey, '.png'))))""")
    return customers.select(record.cast("binary").alias("value"))


@query("SELECT c_custkey, 'user' || c_custkey AS username FROM customer")
def struct_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of a nested record by path."""
    record = decode_messages(nested_users(spark, folder), RECORD)
    return record.select(
        F.col("location")["street"]["number"].cast("bigint").alias("c_custkey"), F.col("login.username").alias("username")
    )


ALL_FORMATS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, f AS file_format
FROM orders, (SELECT unnest(['json', 'csv', 'parquet']) AS f)"""


@query(ALL_FORMATS)
def file_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """A table written as JSON, CSV and Parquet, and read back."""
    base, day = shared_path(spark, "files"), dt.date(2024, 9, 4)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    paths = {name: files.landing_path(base, day, 0, name) for name in ("json", "csv", "parquet")}
    files.write_json(orders, paths["json"])
    files.write_csv(orders, paths["csv"])
    files.write_parquet(orders, paths["parquet"], max_records_per_file=1_000_000)
    reader = spark.read.schema(orders.schema)
    back = {
        "json": reader.json(paths["json"]),
        "csv": reader.option("header", True).option("sep", files.CSV_SEPARATOR).csv(paths["csv"]),
        "parquet": spark.read.schema(orders.schema).parquet(paths["parquet"]),
    }
    frames = [frame.withColumn("file_format", F.lit(name)) for name, frame in back.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    """A partition written twice holds its last version only."""
    path = shared_path(spark, "partitioned")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    files.write_partitioned(orders, path, ["o_orderstatus"])
    files.write_partitioned(orders.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path).select("o_orderkey", "o_orderstatus")
