"""Ad clicks: decoding, enrichment, the processed ledger and the click reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.agents import browser_family, device_type, os_family
from siltwork.functions.dates import time_of_day
from siltwork.functions.messages import CORRUPT, encode_rows, message_text
from siltwork.functions.network import ipv4_number
from siltwork.functions.people import AGE_BAND_ORDER, TIME_OF_DAY_ORDER, age_group
from siltwork.operators import reports
from siltwork.operators.columns import keep_listed
from siltwork.operators.geo import locate
from siltwork.operators.merge import mark_processed, unprocessed
from siltwork.plans import clicks
from siltwork.queries import inputs
from siltwork.queries.inputs import CLICKS_SQL, NATION_BANDS_SQL
from siltwork.queries.registry import query, table
from siltwork.sources.jdbc import ready_on, uploaded_on

CLICK_COLUMNS = (
    "username, age, gender, ad_position, browsing_history, activity_time, ip_address, log, redirect_from, redirect_to"
)
DAY = dt.date(2024, 1, 10)

AGE_CASE = """CASE WHEN age IS NULL OR age = 0 THEN 'None' WHEN age >= 60 THEN '60+' WHEN age >= 41 THEN '41-60'
     WHEN age >= 26 THEN '26-40' WHEN age >= 18 THEN '18-25' ELSE '1-18' END"""
DAY_CASE = """CASE WHEN hour({0}) BETWEEN 5 AND 11 THEN 'morning' WHEN hour({0}) BETWEEN 12 AND 17 THEN 'afternoon'
     WHEN hour({0}) BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END"""
DEVICE_CASE = """CASE WHEN regexp_matches(log, 'Tablet|iPad') THEN 'Tablet'
     WHEN regexp_matches(log, 'Mobile|iPhone') THEN 'Mobile' ELSE 'Laptop' END"""
OS_CASE = """CASE WHEN regexp_matches(log, 'Windows NT') THEN 'Windows' WHEN regexp_matches(log, 'Android') THEN 'Android'
     WHEN regexp_matches(log, 'iPhone|iPad') THEN 'iOS' WHEN regexp_matches(log, 'Macintosh|Mac OS X') THEN 'Mac OS X'
     WHEN regexp_matches(log, 'Linux') THEN 'Linux' ELSE 'Other' END"""
BROWSER_CASE = """CASE WHEN regexp_matches(log, 'Edge?/') THEN 'Edge' WHEN regexp_matches(log, 'Opera/|OPR/') THEN 'Opera'
     WHEN regexp_matches(log, 'Firefox/') THEN 'Firefox' WHEN regexp_matches(log, 'Chrome/') THEN 'Chrome'
     WHEN regexp_matches(log, 'Safari/') THEN 'Safari' ELSE 'Other' END"""

DECODED = f"""WITH {CLICKS_SQL}, {NATION_BANDS_SQL}, decoded AS (
  SELECT {CLICK_COLUMNS}, ip_number FROM clicks WHERE is_json
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM clicks WHERE NOT is_json
)"""

ENRICHED = f"""{DECODED}, enriched AS (
  SELECT age, gender, ad_position, browsing_history, activity_time, ip_address, log, redirect_from, redirect_to,
         coalesce(country, 'Unknown') AS country, coalesce(city, 'Unknown') AS city,
         {AGE_CASE} AS age_group, CAST(hour(activity_time) AS INTEGER) AS hours,
         {DAY_CASE.format('activity_time')} AS time_of_day, {DEVICE_CASE} AS device_type, {OS_CASE} AS os_family,
         {BROWSER_CASE} AS browser_family
  FROM decoded LEFT JOIN bands ON ip_number BETWEEN ip_from AND ip_to
)"""


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.decode_clicks(inputs.click_messages(spark, folder)).withColumn(
        "activity_time", F.col("activity_time").cast("timestamp_ntz")
    )


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.enrich(_decoded(spark, folder), inputs.nation_bands(spark, folder))


@query(f"""WITH {CLICKS_SQL}
SELECT {CLICK_COLUMNS} FROM clicks WHERE is_json
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM clicks WHERE NOT is_json""")
def click_decode(spark: SparkSession, folder: str) -> DataFrame:
    return _decoded(spark, folder)


@query("SELECT 'broken message ' || event_id AS message FROM events WHERE event_id % 97 = 0")
def click_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Original text of the messages that are not JSON."""
    decoded = clicks.decode_clicks(inputs.click_messages(spark, folder), keep_corrupt=True)
    return decoded.where(F.col(CORRUPT).isNotNull() & F.col("username").isNull()).select(F.col(CORRUPT).alias("message"))


@query(f"{ENRICHED} SELECT * FROM enriched")
def click_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder)


@query(f"""{ENRICHED}, t AS (SELECT country, COUNT(country) AS amount FROM enriched GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY amount DESC) AS rank FROM t""")
def clicks_by_country_rank(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.REPORTS["df_country"](_enriched(spark, folder))


@query(f"""{ENRICHED}, t AS (SELECT city, COUNT(city) AS amount FROM enriched GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY amount DESC) AS rank FROM t""")
def clicks_by_city_rank(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.REPORTS["df_city"](_enriched(spark, folder))


@query(f"""{ENRICHED} SELECT age_group, time_of_day, COUNT(age_group) AS amount FROM enriched GROUP BY ALL""")
def clicks_by_group_and_time(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.REPORTS["df_age_group"](_enriched(spark, folder))


@query("""
WITH t AS (SELECT event_type, COUNT(event_type) AS amount FROM events GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY amount DESC) AS rank FROM t""")
def clicks_by_type_rank(spark: SparkSession, folder: str) -> DataFrame:
    return reports.clicks_ranked(table(spark, folder, "events"), "event_type")


@query("""
WITH t AS (SELECT user_id, COUNT(user_id) AS amount FROM events GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY amount DESC) AS rank FROM t""")
def clicks_by_user_rank(spark: SparkSession, folder: str) -> DataFrame:
    """A rank over as many groups as there are users."""
    return reports.clicks_ranked(table(spark, folder, "events"), "user_id")


@query(f"""
WITH aged AS (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS age, ts FROM events)
SELECT {AGE_CASE} AS age_group, {DAY_CASE.format('ts')} AS time_of_day, COUNT(*) AS amount FROM aged GROUP BY ALL""")
def clicks_by_age_time(spark: SparkSession, folder: str) -> DataFrame:
    age = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, folder, "events").select(
        age_group(age, clicks.NO_AGE).alias("age_group"), time_of_day(F.hour("ts")).alias("time_of_day")
    )
    return reports.clicks_by_lists(events, ("age_group", AGE_BAND_ORDER), ("time_of_day", TIME_OF_DAY_ORDER))


MONTHS = """
WITH months AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS years, CAST(month(o_orderdate) AS INTEGER) AS month,
         COUNT(*) AS current_period_amount
  FROM orders GROUP BY ALL
), compared AS (
  SELECT *, lag(current_period_amount, 1, 0) OVER (ORDER BY years, month) AS previous_period_amount,
         CAST(SUM(current_period_amount) OVER ({window}) AS BIGINT) AS year_sum
  FROM months)
SELECT *, current_period_amount - previous_period_amount AS increase,
       current_period_amount > previous_period_amount AS clicks_increase,
       round(current_period_amount / year_sum * 100, 2) AS percentage_per_year
FROM compared"""


@query(MONTHS.format(window="ORDER BY years"))
def clicks_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return reports.clicks_by_month(table(spark, folder, "orders"), "o_orderdate")


@query(MONTHS.format(window="PARTITION BY years"))
def clicks_by_month_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return reports.clicks_by_month(table(spark, folder, "orders"), "o_orderdate", per_year=True)


@query(f"""{DECODED}, described AS (
  SELECT {DEVICE_CASE} AS device_type, {OS_CASE} AS os_family, {BROWSER_CASE} AS browser_family FROM decoded)
SELECT device_type, os_family, browser_family, COUNT(*) AS amount FROM described GROUP BY ALL""")
def ua_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    agents = _decoded(spark, folder).select(
        device_type(F.col("log")).alias("device_type"),
        os_family(F.col("log")).alias("os_family"),
        browser_family(F.col("log")).alias("browser_family"),
    )
    return agents.groupBy("device_type", "os_family", "browser_family").agg(F.count("*").alias("amount"))


@query(f"""{DECODED}
SELECT ip_address, ip_number, coalesce(country, 'Unknown') AS country, coalesce(city, 'Unknown') AS city,
       coalesce(region, 'Unknown') AS region
FROM decoded LEFT JOIN bands ON ip_number BETWEEN ip_from AND ip_to""")
def ip_geo(spark: SparkSession, folder: str) -> DataFrame:
    addresses = _decoded(spark, folder).select(
        "ip_address", ipv4_number(F.col("ip_address")).alias("ip_number")
    )
    return locate(addresses, inputs.nation_bands(spark, folder))


@query(f"""{DECODED}
SELECT ip_address, coalesce(c_name, 'Unknown') AS c_name
FROM decoded LEFT JOIN customer ON ip_number BETWEEN c_custkey * 28000 AND c_custkey * 28000 + 20999""")
def ip_geo_many_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Bands as many as there are customers, several to one address prefix."""
    bands = table(spark, folder, "customer").selectExpr(
        "c_custkey * 28000 AS ip_from", "c_custkey * 28000 + 20999 AS ip_to", "c_name"
    )
    addresses = _decoded(spark, folder).select("ip_address")
    return locate(addresses, bands, fields=("c_name",))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes to text to a typed column."""
    messages = table(spark, folder, "events").select("event_id", F.encode("props", "UTF-8").alias("value"))
    typed = F.from_json(message_text(F.col("value")), "k int")
    return messages.select("event_id", typed["k"].alias("k"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS key,
       '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
FROM events""")
def json_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Each row as one JSON message, as the topic writer sends it."""
    return encode_rows(table(spark, folder, "events").select("event_id", "user_id", "event_type"), "event_id")


def _stored_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """The click table: an id, when it arrived and whether it was processed."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS id", "ts AS created_at",
        "CASE WHEN event_id % 7 = 0 THEN 'transformed' ELSE 'uploaded' END AS status",
    )


STORED = """WITH stored AS (
  SELECT event_id AS id, ts AS created_at,
         CASE WHEN event_id % 7 = 0 THEN 'transformed' ELSE 'uploaded' END AS status FROM events)"""


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of processed clicks, some listed twice."""
    even = table(spark, folder, "events").where("event_id % 2 = 0").selectExpr("event_id AS id")
    return even.unionAll(even.where("id % 6 = 0"))


@query(f"{STORED} SELECT * FROM stored WHERE status = 'uploaded' AND CAST(created_at AS DATE) = DATE '2024-01-10'")
def uploaded_of_day(spark: SparkSession, folder: str) -> DataFrame:
    return uploaded_on(_stored_clicks(spark, folder), DAY)


@query(f"{STORED} SELECT id, created_at, CASE WHEN id % 2 = 0 THEN 'transformed' ELSE status END AS status FROM stored", name="mark_processed")
def clicks_marked(spark: SparkSession, folder: str) -> DataFrame:
    return mark_processed(_stored_clicks(spark, folder), _ledger(spark, folder), "id")


@query(f"{STORED} SELECT * FROM stored WHERE status = 'uploaded' AND id % 2 <> 0")
def clicks_waiting(spark: SparkSession, folder: str) -> DataFrame:
    return clicks.waiting_clicks(_stored_clicks(spark, folder), _ledger(spark, folder))


@query("SELECT * FROM events WHERE event_id % 2 <> 0", name="unprocessed")
def unprocessed_events(spark: SparkSession, folder: str) -> DataFrame:
    ledger = _ledger(spark, folder).withColumnRenamed("id", "event_id")
    return unprocessed(table(spark, folder, "events"), ledger, "event_id")


@query("SELECT * FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def events_of_listed_users(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey AS user_id")
    return keep_listed(table(spark, folder, "events"), keys, "user_id").select(
        *table(spark, folder, "events").columns
    )


@query("SELECT EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10') AS ready")
def ready_probe(spark: SparkSession, folder: str) -> DataFrame:
    return ready_on(table(spark, folder, "events"), DAY, "ts")


@query("SELECT EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = DATE '2031-01-01') AS ready")
def ready_probe_of_empty_day(spark: SparkSession, folder: str) -> DataFrame:
    return ready_on(table(spark, folder, "events"), dt.date(2031, 1, 1), "ts")
