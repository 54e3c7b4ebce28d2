"""The shop model over the given tables: silver dimensions and facts, gold reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.operators.facts import order_headers, orphans
from siltwork.operators.keys import best_per_key, dimension, lookup_key, number_all_rows, number_rows
from siltwork.plans import shop
from siltwork.queries import inputs
from siltwork.queries.inputs import LINES_SQL, LOGINS_SQL, USERS_SQL
from siltwork.queries.registry import query, table
from siltwork.shared import shared_path

AS_OF = dt.date(2024, 6, 15)


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, the type of the given tables."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return shop.clean_users(inputs.users(spark, folder), AS_OF)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return shop.clean_orders(inputs.lines(spark, folder))


def _logins(spark: SparkSession, folder: str) -> DataFrame:
    return shop.clean_logins(inputs.logins(spark, folder))


PARTS = """
CASE len(string_split({a}, ',')) WHEN 4 THEN trim(string_split({a}, ',')[1], ' ')
     WHEN 3 THEN trim(string_split({a}, ',')[1], ' ') ELSE '' END AS street1,
CASE len(string_split({a}, ',')) WHEN 4 THEN trim(string_split({a}, ',')[2], ' ') ELSE '' END AS street2,
CASE len(string_split({a}, ',')) WHEN 4 THEN trim(string_split({a}, ',')[3], ' ')
     WHEN 3 THEN trim(string_split({a}, ',')[2], ' ') ELSE '' END AS city,
CASE len(string_split({a}, ',')) WHEN 4 THEN trim(string_split({a}, ',')[4], ' ')
     WHEN 3 THEN trim(string_split({a}, ',')[3], ' ') ELSE '' END AS country"""

# Months between two midnights: whole months plus days over 31, except when
# both are the same day of the month or both the last one.
AGES = """
aged AS (
  SELECT *, CAST(round((12 * (2024 - year(dob)) + (6 - month(dob))
              + CASE WHEN day(dob) = 15 THEN 0 ELSE (15 - day(dob)) / 31.0 END) / 12) AS INTEGER) AS age
  FROM users
),
clean_users AS (
  SELECT *, CASE WHEN age >= 60 THEN '60+' WHEN age >= 41 THEN '41-60' WHEN age >= 26 THEN '26-40'
                 WHEN age >= 18 THEN '18-25' ELSE '1-18' END AS age_group, """ + PARTS.format(a="address") + """
  FROM aged
)"""

CLEAN_LINES = f"""
clean_lines AS (
  SELECT id, customer_email, order_date, delivery_address, product_name, product_category, product_brand,
         product_description, quantity, unit_price,
         CAST(quantity * unit_price AS DECIMAL(10,2)) AS total_price,
         quantity * unit_price <> total_price AS was_repaired,
         CAST(order_date AS DATE) AS date, CAST(month(order_date) AS INTEGER) AS month,
         {PARTS.format(a='delivery_address')}
  FROM lines
)"""

BASE = f"WITH {USERS_SQL}, {LINES_SQL}, {LOGINS_SQL}, {AGES}, {CLEAN_LINES}"

ADDRESS = """
addresses AS (
  SELECT row_number() OVER (ORDER BY address) AS id, address, street1, street2, city, country
  FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY origin, street1, street2, city, country) AS n
        FROM (SELECT address, street1, street2, city, country, 0 AS origin FROM clean_users
              UNION ALL SELECT delivery_address, street1, street2, city, country, 1 FROM clean_lines))
  WHERE n = 1
)"""

DIMENSIONS = """
genders AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT gender AS name FROM users)),
categories AS (SELECT row_number() OVER (ORDER BY name) AS id, name
               FROM (SELECT DISTINCT product_category AS name FROM lines)),
devices AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT device AS name FROM logins))"""

PRODUCTS = """
products AS (
  SELECT row_number() OVER (ORDER BY name) AS id, name, category_id, brand, price, description
  FROM (SELECT product_name AS name, c.id AS category_id, product_brand AS brand, unit_price AS price,
               product_description AS description,
               row_number() OVER (PARTITION BY product_name
                                  ORDER BY l.id DESC, c.id DESC, product_brand DESC, unit_price DESC,
                                           product_description DESC) AS n
        FROM lines l JOIN categories c ON c.name = l.product_category)
  WHERE n = 1
)"""

HEADERS = """
headers AS (
  SELECT *, row_number() OVER (ORDER BY date, customer_email, delivery_address) AS order_id
  FROM (SELECT customer_email, date, delivery_address, COUNT(*) AS order_items_amount,
               CAST(SUM(total_price) AS DECIMAL(20,2)) AS order_total_price
        FROM clean_lines GROUP BY ALL)
),
orders_made AS (
  SELECT h.order_id AS id, u.id AS customer_id, u.email, h.date AS order_date,
         h.order_total_price AS total_price, a.id AS delivery_address_id
  FROM headers h JOIN users u ON u.email = h.customer_email JOIN addresses a ON a.address = h.delivery_address
)"""


@query(f"{BASE} SELECT * FROM clean_users")
def cleaned_users(spark: SparkSession, folder: str) -> DataFrame:
    return _naive(_users(spark, folder))


@query(f"{BASE} SELECT * FROM logins")
def cleaned_logs(spark: SparkSession, folder: str) -> DataFrame:
    return _naive(_logins(spark, folder))


@query(f"{BASE} SELECT * FROM clean_lines")
def cleaned_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _naive(_lines(spark, folder))


@query(f"{BASE}, {ADDRESS} SELECT * FROM addresses")
def address_dim(spark: SparkSession, folder: str) -> DataFrame:
    return shop.address_dimension(_users(spark, folder), _lines(spark, folder))


@query(f"{BASE}, {DIMENSIONS} SELECT * FROM genders")
def gender_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(_users(spark, folder), "gender")


@query("""
SELECT row_number() OVER (ORDER BY name) AS id, name
FROM (SELECT DISTINCT p_type AS name FROM lineitem JOIN part ON l_partkey = p_partkey)""")
def category_dim(spark: SparkSession, folder: str) -> DataFrame:
    sold = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
    return dimension(sold, "p_type")


@query("SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT event_type AS name FROM events)")
def device_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(_logins(spark, folder), "device")


@query(f"""{BASE}, {ADDRESS}, {DIMENSIONS}
SELECT u.id, first_name, last_name, email, a.id AS address_id, g.id AS gender_id,
       strftime(dob, '%Y-%m-%d %H:%M:%S') AS dob, phone_number
FROM users u LEFT JOIN genders g ON g.name = u.gender LEFT JOIN addresses a ON a.address = u.address""")
def users_full(spark: SparkSession, folder: str) -> DataFrame:
    users = _users(spark, folder)
    addresses = shop.address_dimension(users, _lines(spark, folder))
    return shop.users_full(users, dimension(users, "gender"), addresses)


@query(f"""{BASE}, {DIMENSIONS}
SELECT l.id, strftime(login_date, '%Y-%m-%d %H:%M:%S') AS login_date,
       strftime(logout_date, '%Y-%m-%d %H:%M:%S') AS logout_date, u.id AS user_id, d.id AS device_id
FROM logins l JOIN users u ON u.email = l.user_email JOIN devices d ON d.name = l.device""")
def logs_full(spark: SparkSession, folder: str) -> DataFrame:
    logins = _logins(spark, folder)
    return shop.logs_full(logins, _users(spark, folder), dimension(logins, "device"))


@query(f"{BASE}, {DIMENSIONS}, {PRODUCTS} SELECT * FROM products")
def product_full(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return shop.product_full(lines, dimension(lines, "product_category"))


@query(f"{BASE}, {ADDRESS}, {HEADERS} SELECT * FROM headers")
def order_headers_numbered(spark: SparkSession, folder: str) -> DataFrame:
    return shop.numbered_headers(_lines(spark, folder))


@query(f"{BASE}, {ADDRESS}, {HEADERS} SELECT * FROM orders_made")
def orders_full(spark: SparkSession, folder: str) -> DataFrame:
    users, lines = _users(spark, folder), _lines(spark, folder)
    known = shop.known_headers(shop.numbered_headers(lines), users, shop.address_dimension(users, lines))
    return shop.orders_full(known)


@query(f"""{BASE}, {ADDRESS}, {DIMENSIONS}, {PRODUCTS}, {HEADERS}
SELECT l.id, o.id AS order_id, p.id AS product_id, l.quantity, l.unit_price, l.total_price
FROM clean_lines l JOIN addresses a ON a.address = l.delivery_address
JOIN orders_made o ON o.email = l.customer_email AND o.order_date = l.date AND o.delivery_address_id = a.id
JOIN products p ON p.name = l.product_name""")
def order_items_full(spark: SparkSession, folder: str) -> DataFrame:
    """The last table of the silver build, with those it needs."""
    silver = shop.build_silver(
        inputs.users(spark, folder), inputs.logins(spark, folder), inputs.lines(spark, folder), AS_OF
    )
    return silver.order_items_full


SOLD = f"{BASE}, sold AS (SELECT l.*, gender, age_group FROM clean_lines l JOIN clean_users u ON u.email = l.customer_email)"
GOLD_DAYS = f"""{BASE}, days AS (
  SELECT month, date, CAST(SUM(total_price) AS DECIMAL(20,2)) AS total_income,
         SUM(CAST(total_price * 100 AS HUGEINT)) AS cents
  FROM clean_lines GROUP BY ALL)"""


def _gold(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return shop.GOLD[name](_users(spark, folder), _lines(spark, folder))


@query(f"""{BASE} SELECT CAST(hour(order_date) AS INTEGER) AS hours, CAST(SUM(total_price) AS DECIMAL(20,2)) AS total_income
FROM clean_lines GROUP BY ALL""")
def gold_income_by_hours(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder, "total_income_by_hours")


@query(f"""{SOLD}, t AS (SELECT gender, CAST(SUM(total_price) AS DECIMAL(30,2)) AS total_income FROM sold GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY total_income) AS rank FROM t""")
def gold_income_by_genders(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder, "total_income_by_genders")


@query(f"{GOLD_DAYS} SELECT date, total_income FROM days")
def gold_income_by_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder, "total_income_by_dates")


@query(f"""{GOLD_DAYS} SELECT month, date, total_income,
       lag(total_income, 1, 0) OVER (ORDER BY month, date) AS prev_income,
       CAST(total_income - lag(total_income, 1, 0) OVER (ORDER BY month, date) AS DECIMAL(21,2)) AS profit
FROM days""")
def gold_income_by_dates_with_month(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder, "total_income_by_dates_with_month")


@query(f"""{GOLD_DAYS}, averaged AS (
  SELECT month, date, total_income,
         CAST(CAST((2 * SUM(cents) OVER w + COUNT(*) OVER w) // (2 * COUNT(*) OVER w) AS DECIMAL(18,0))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(25,2)) AS avg_month
  FROM days WINDOW w AS (ORDER BY month))
SELECT *, total_income >= avg_month AS income_more_than_month_avg FROM averaged""")
def gold_income_by_avg_month(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder, "total_income_by_avg_month")


@query(f"""{SOLD} SELECT gender, age_group, CAST(SUM(total_price) AS DECIMAL(30,2)) AS total_income
FROM sold GROUP BY ALL""")
def gold_profit_by_age_group_and_gender(spark: SparkSession, folder: str) -> DataFrame:
    return _gold(spark, folder, "profit_by_age_group_and_gender")


def _refreshed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report after two batches of lines, the second of late lines in two months of each year."""
    refresh = shop.GoldRefresh(spark, shared_path(spark, "gold"))
    lines = _lines(spark, folder)
    late = (F.col("id") % 3 == 0) & F.month("order_date").isin(2, 9)
    whole = refresh.add(lines.where(~late), 0)
    changed = refresh.add(lines.where(late), 1)
    if not len(changed) < len(whole):
        raise ValueError("the second batch read all months")
    return refresh.reports(_users(spark, folder))[name]


@query(f"""{GOLD_DAYS} SELECT month, date, CAST(total_income AS DECIMAL(30,2)) AS total_income,
       lag(CAST(total_income AS DECIMAL(30,2)), 1, 0) OVER (ORDER BY month, date) AS prev_income,
       CAST(total_income - lag(total_income, 1, 0) OVER (ORDER BY month, date) AS DECIMAL(31,2)) AS profit
FROM days""")
def gold_refreshed_dates_with_month(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, folder, "total_income_by_dates_with_month")


@query(f"""{SOLD} SELECT gender, age_group, CAST(SUM(total_price) AS DECIMAL(38,2)) AS total_income
FROM sold GROUP BY ALL""")
def gold_refreshed_age_group_and_gender(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, folder, "profit_by_age_group_and_gender")


@query(f"""{BASE}, names AS (SELECT product_category AS name, min(CASE WHEN month(order_date) < 7 THEN 0 ELSE 1 END) AS batch FROM clean_lines GROUP BY 1)
SELECT row_number() OVER (ORDER BY batch, name NULLS FIRST) AS id, name FROM names""")
def category_ids_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Category ids after a run over the first half of each year and one over all lines."""
    lines, ids = _lines(spark, folder), shared_path(spark, "ids")
    shop.stable_dimension(lines.where(F.month("order_date") < 7), "product_category", ids)
    return shop.stable_dimension(lines, "product_category", ids)


@query("""
SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                             l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS id
FROM lineitem""")
def surrogate_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids over raw rows whose natural key repeats."""
    return number_all_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("""
SELECT row_number() OVER (ORDER BY event_type, device_key) AS id, event_type, device_key
FROM (SELECT event_type, user_id % 3 AS device_key FROM events)""")
def ids_of_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Ids over a table where almost every row has many identical copies."""
    events = table(spark, folder, "events").selectExpr("event_type", "user_id % 3 AS device_key")
    return number_all_rows(events, ["event_type", "device_key"])


@query("""
SELECT p_name, p_partkey, p_brand, p_type, p_size, p_retailprice,
       row_number() OVER (ORDER BY p_name) AS id
FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS n FROM part) WHERE n = 1""")
def latest_product(spark: SparkSession, folder: str) -> DataFrame:
    newest = best_per_key(table(spark, folder, "part"), ["p_name"], ["p_partkey"])
    return number_rows(newest, ["p_name"])


@query("""
WITH segments AS (SELECT row_number() OVER (ORDER BY name) AS id, name
                  FROM (SELECT DISTINCT c_mktsegment AS name FROM customer))
SELECT c_custkey, c_name, segments.id AS segment_id, n_nationkey AS nation_id
FROM customer LEFT JOIN segments ON name = c_mktsegment
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON n_nationkey = c_nationkey""")
def users_with_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Left joins to dimensions; customers of region 0 find no nation."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation").where("n_regionkey <> 0")
    with_segment = lookup_key(customers, dimension(customers, "c_mktsegment"), "c_mktsegment", "segment_id")
    with_nation = lookup_key(
        with_segment, nations, "c_nationkey", "nation_id", dim_key="n_nationkey", dim_id="n_nationkey"
    )
    return with_nation.select("c_custkey", "c_name", "segment_id", "nation_id")


@query("""
WITH kinds AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT event_type AS name FROM events))
SELECT event_id, ts, c_custkey AS user_key, kinds.id AS type_id
FROM events JOIN customer ON c_custkey = user_id JOIN kinds ON name = event_type""")
def login_fact(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    with_user = lookup_key(
        events, table(spark, folder, "customer"), "user_id", "user_key", dim_key="c_custkey", dim_id="c_custkey",
        how="inner",
    )
    with_type = lookup_key(with_user, dimension(events, "event_type"), "event_type", "type_id", how="inner")
    return with_type.select("event_id", "ts", "user_key", "type_id")


@query("""
SELECT *, row_number() OVER (ORDER BY date, o_custkey, o_orderpriority) AS id
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderpriority, COUNT(*) AS order_items_amount,
             CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS order_total_price
      FROM orders GROUP BY ALL)""", name="order_headers")
def order_roll_up(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_custkey", "CAST(o_orderdate AS DATE) AS date", "o_orderpriority",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total_price",
    )
    return order_headers(orders, ["o_custkey", "date", "o_orderpriority"], "total_price", ["date", "o_custkey"])


@query("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)")
def orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers nobody logged in as."""
    return orphans(table(spark, folder, "customer"), table(spark, folder, "events"), "c_custkey", "user_id")


@query(f"{BASE} SELECT id, user_email, device FROM logins WHERE user_email NOT IN (SELECT email FROM users)")
def orphan_logins(spark: SparkSession, folder: str) -> DataFrame:
    """Logins whose e-mail belongs to no user."""
    found = orphans(inputs.logins(spark, folder), inputs.users(spark, folder), "user_email", "email")
    return found.select("id", "user_email", "device")
