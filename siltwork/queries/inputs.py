"""The given tables in the shape of the jobs' inputs, by arithmetic on their keys.

Each builder has a SQL twin in ``sql_*`` that the checks start from.  A few
rows get the faults the jobs must handle: unknown e-mails, second addresses on
a day, wrong totals, blank ages, messages that are not JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.queries.registry import table

USERS_SQL = """
users AS (
  SELECT c_custkey AS id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         'user' || c_custkey || '@example.com' AS email,
         c_mktsegment AS gender,
         TIMESTAMP '1930-01-01' + to_days(CAST((c_custkey * 37) % 28000 AS INTEGER)) AS dob,
         '+' || c_nationkey || '-' || c_custkey AS phone_number,
         CASE WHEN c_custkey % 2 = 0
              THEN (c_custkey % 500) || ' Main Street, Flat ' || (c_custkey % 9) || ', ' || n_name || ', ' || r_name
              ELSE (c_custkey % 500) || ' High Road, ' || n_name || ', ' || r_name END AS address
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

LINES_SQL = """
lines AS (
  SELECT l_orderkey * 8 + l_linenumber AS id,
         CASE WHEN o_orderkey % 97 = 0 THEN 'guest' || o_orderkey || '@example.org'
              ELSE 'user' || o_custkey || '@example.com' END AS customer_email,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_date,
         CASE WHEN o_orderkey % 10 = 0
              THEN (o_custkey % 300) || ' Dock Lane, Unit ' || (o_orderkey % 7) || ', ' || n_name || ', ' || r_name
              ELSE (o_custkey % 500) || ' Main Street, , ' || n_name || ', ' || r_name END AS delivery_address,
         p_name AS product_name, p_type AS product_category, p_brand AS product_brand,
         p_type || ' ' || p_name AS product_description,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS total_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

LOGINS_SQL = """
logins AS (
  SELECT event_id AS id, ts AS login_date,
         ts + to_hours(CAST(1 + event_id % 8 AS INTEGER)) AS logout_date,
         CASE WHEN event_id % 101 = 0 THEN 'guest' || event_id || '@example.org'
              ELSE 'user' || user_id || '@example.com' END AS user_email,
         event_type AS device
  FROM events
)"""

# One click per event; ``is_json`` marks the messages that can be decoded.
CLICKS_SQL = """
clicks AS (
  SELECT event_id, event_id % 97 <> 0 AS is_json,
         'user' || user_id AS username,
         CASE WHEN event_id % 50 = 0 OR event_id % 51 = 0 THEN NULL
              ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS age,
         ['male','female','non-binary'][CAST(user_id % 3 AS INTEGER) + 1] AS gender,
         ['top-banner','sidebar','inline','footer','popup'][CAST(event_id % 5 AS INTEGER) + 1] AS ad_position,
         event_type AS browsing_history,
         date_trunc('second', ts) AS activity_time,
         (n // 16777216) || '.' || ((n // 65536) % 256) || '.' || ((n // 256) % 256) || '.' || (n % 256) AS ip_address,
         n AS ip_number,
         'Mozilla/5.0 (' ||
           ['Windows NT 10.0','Linux; Android 9','Macintosh; Intel Mac OS X 10_12'][CAST(event_id % 3 AS INTEGER) + 1]
           || '; ' || ['Mobile','Tablet','Laptop'][CAST((event_id // 3) % 3 AS INTEGER) + 1]
           || ') AppleWebKit/537.36 (KHTML, like Gecko) '
           || ['Chrome','Firefox','Safari','Edge','Opera'][CAST((event_id // 9) % 5 AS INTEGER) + 1] || '/'
           || (50 + event_id % 51) || '.0  Safari/537.36' AS log,
         'site' || (event_id % 50) || '.example.com' AS redirect_from,
         'shop' || (event_id % 150) || '.example.com' AS redirect_to
  FROM (SELECT *, (event_id % 65536) * 40503 % 65536 * 65536 + event_id % 65536 AS n FROM events)
)"""

NATION_BANDS_SQL = """
bands AS (
  SELECT n_nationkey * CAST(171798691 AS BIGINT) AS ip_from,
         n_nationkey * CAST(171798691 AS BIGINT) + 150000000 AS ip_to,
         n_name AS country, n_name || ' town ' || (n_nationkey % 4) AS city, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

SETTLED_SQL = """
charges AS (
  SELECT o_orderkey AS charge_no, o_custkey AS customer_no,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount_captured,
         CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'P' THEN 'pending' ELSE 'failed' END AS status,
         CASE WHEN o_orderkey % 11 = 0 THEN 'declined_by_network' ELSE 'approved_by_network' END
           AS outcome_network_status,
         o_orderkey % 13 <> 0 AS paid
  FROM orders
)"""


def users(spark: SparkSession, folder: str) -> DataFrame:
    people = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return people.selectExpr(
        "c_custkey AS id",
        "split_part(c_name, '#', 1) AS first_name",
        "split_part(c_name, '#', 2) AS last_name",
        "concat('user', c_custkey, '@example.com') AS email",
        "c_mktsegment AS gender",
        "TIMESTAMP_NTZ '1930-01-01' + make_dt_interval(CAST(c_custkey * 37 % 28000 AS INT)) AS dob",
        "concat('+', c_nationkey, '-', c_custkey) AS phone_number",
        """CASE WHEN c_custkey % 2 = 0
                THEN concat(c_custkey % 500, ' Main Street, Flat ', c_custkey % 9, ', ', n_name, ', ', r_name)
                ELSE concat(c_custkey % 500, ' High Road, ', n_name, ', ', r_name) END AS address""",
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    sold = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return sold.selectExpr(
        "l_orderkey * 8 + l_linenumber AS id",
        """CASE WHEN o_orderkey % 97 = 0 THEN concat('guest', o_orderkey, '@example.org')
                ELSE concat('user', o_custkey, '@example.com') END AS customer_email""",
        "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS order_date",
        """CASE WHEN o_orderkey % 10 = 0
                THEN concat(o_custkey % 300, ' Dock Lane, Unit ', o_orderkey % 7, ', ', n_name, ', ', r_name)
                ELSE concat(o_custkey % 500, ' Main Street, , ', n_name, ', ', r_name) END AS delivery_address""",
        "p_name AS product_name",
        "p_type AS product_category",
        "p_brand AS product_brand",
        "concat(p_type, ' ', p_name) AS product_description",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price",
        "CAST(l_extendedprice AS DECIMAL(10,2)) AS total_price",
    )


def logins(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS id",
        "ts AS login_date",
        "ts + make_dt_interval(0, CAST(1 + event_id % 8 AS INT)) AS logout_date",
        """CASE WHEN event_id % 101 = 0 THEN concat('guest', event_id, '@example.org')
                ELSE concat('user', user_id, '@example.com') END AS user_email""",
        "event_type AS device",
    )


def click_messages(spark: SparkSession, folder: str) -> DataFrame:
    """``event_id`` and the message bytes; 1 in 97 is not JSON, some ages are blank or null."""
    numbered = table(spark, folder, "events").withColumn(
        "n", F.expr("(event_id % 65536) * 40503 % 65536 * 65536 + event_id % 65536")
    )
    return numbered.selectExpr(
        "event_id",
        """CAST(CASE WHEN event_id % 97 = 0 THEN concat('broken message ', event_id) ELSE concat(
             '{"username":"user', user_id,
             '","age":', CASE WHEN event_id % 50 = 0 THEN '""' WHEN event_id % 51 = 0 THEN 'null'
                              ELSE get_json_object(props, '$.k') END,
             ',"gender":"', element_at(array('male', 'female', 'non-binary'), CAST(user_id % 3 AS INT) + 1),
             '","ad_position":"', element_at(array('top-banner', 'sidebar', 'inline', 'footer', 'popup'),
                                             CAST(event_id % 5 AS INT) + 1),
             '","browsing_history":"', event_type,
             '","activity_time":"', date_format(ts, 'yyyy-MM-dd HH:mm:ss'),
             '","ip_address":"', concat_ws('.', n div 16777216, n div 65536 % 256, n div 256 % 256, n % 256),
             '","log":"Mozilla/5.0 (',
             element_at(array('Windows NT 10.0', 'Linux; Android 9', 'Macintosh; Intel Mac OS X 10_12'),
                        CAST(event_id % 3 AS INT) + 1),
             '; ', element_at(array('Mobile', 'Tablet', 'Laptop'), CAST(event_id div 3 % 3 AS INT) + 1),
             ') AppleWebKit/537.36 (KHTML, like Gecko) ',
             element_at(array('Chrome', 'Firefox', 'Safari', 'Edge', 'Opera'), CAST(event_id div 9 % 5 AS INT) + 1),
             '/', 50 + event_id % 51, '.0  Safari/537.36',
             '","redirect_from":"site', event_id % 50, '.example.com',
             '","redirect_to":"shop', event_id % 150, '.example.com"}') END AS BINARY) AS value""",
    )


def nation_bands(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return places.selectExpr(
        "n_nationkey * 171798691L AS ip_from",
        "n_nationkey * 171798691L + 150000000 AS ip_to",
        "n_name AS country",
        "concat(n_name, ' town ', n_nationkey % 4) AS city",
        "r_name AS region",
    )


# A number as text in the form of a UUID.
UUID_TEXT = "concat('00000000-0000-4000-8000-', lpad(CAST({} AS STRING), 12, '0'))"
UUID_SQL = "'00000000-0000-4000-8000-' || lpad(CAST({} AS VARCHAR), 12, '0')"


def charges(spark: SparkSession, folder: str) -> DataFrame:
    """The 19 card-charge columns, one charge per order."""
    return table(spark, folder, "orders").selectExpr(
        f"{UUID_TEXT.format('o_orderkey')} AS id",
        "CAST(round(o_totalprice * 100) AS INT) AS amount",
        "CAST(round(o_totalprice * 100) AS INT) AS amount_captured",
        "0 AS amount_refunded",
        "'usd' AS currency",
        "CAST(unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) AS INT) AS created",
        f"{UUID_TEXT.format('o_custkey')} AS customer_id",
        "o_orderpriority AS description",
        "o_orderkey % 17 = 0 AS disputed",
        """CASE WHEN o_orderkey % 11 = 0 THEN 'declined_by_network' ELSE 'approved_by_network' END
             AS outcome_network_status""",
        "CAST(NULL AS STRING) AS outcome_reason",
        "'normal' AS outcome_risk_level",
        "CAST(o_orderkey % 64 AS INT) AS outcome_risk_score",
        "o_orderkey % 13 <> 0 AS paid",
        "concat('pi_', o_orderkey) AS payment_intent",
        "concat('pm_', o_orderkey) AS payment_method",
        "'Visa' AS payment_method_details_card_brand",
        "'US' AS payment_method_details_card_country",
        "CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'P' THEN 'pending' ELSE 'failed' END AS status",
    )


def satisfaction(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        f"{UUID_TEXT.format('c_custkey')} AS customer_id",
        "CAST(c_custkey % 11 AS INT) AS customer_satisfaction_speed",
        "CAST(c_custkey * 3 % 11 AS INT) AS customer_satisfaction_product",
        "CAST(c_custkey * 7 % 11 AS INT) AS customer_satisfaction_service",
        "CASE WHEN c_custkey % 2 = 0 THEN 'product_A' ELSE 'product_B' END AS product_type",
    )
