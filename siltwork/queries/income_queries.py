"""Income reports over orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.money import amount
from siltwork.functions.people import age_group
from siltwork.operators import reports
from siltwork.queries.registry import query, table


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select("o_custkey", "o_orderdate", amount(F.col("o_totalprice")).alias("total_price"))


def _spent_with_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Total per customer, summed before the join so a frequent customer is one row."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    totals = reports.total_by(_orders(spark, folder), ["o_custkey"], "total_price", "total_price")
    return totals.join(customers, F.col("o_custkey") == F.col("c_custkey"))


DAYS = """
WITH days AS (
  SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(o_orderdate AS DATE) AS date,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS income,
         SUM(CAST(ROUND(o_totalprice * 100) AS HUGEINT)) AS cents
  FROM orders GROUP BY ALL
)"""

HALF_UP = (
    "CAST((2 * SUM(cents) OVER w + COUNT(*) OVER w) // (2 * COUNT(*) OVER w) AS DECIMAL(18,0))"
    " * CAST(0.01 AS DECIMAL(3,2))"
)


@query("""
SELECT CAST(hour(ts) AS INTEGER) AS hours,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_income
FROM events GROUP BY ALL""")
def income_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("ts", amount(F.col("value")).alias("value"))
    return reports.income_by_hour(events, "ts", "value")


@query("""
WITH t AS (
  SELECT c_mktsegment, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_income
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY total_income) AS rank FROM t""")
def income_by_segment_rank(spark: SparkSession, folder: str) -> DataFrame:
    return reports.income_by_group_ranked(_spent_with_segment(spark, folder), "c_mktsegment", "total_price")


@query("""
WITH t AS (
  SELECT o_custkey, CAST(SUM(CAST(round(o_totalprice / 10000) AS DECIMAL(18,0))) AS DECIMAL(28,0)) AS total_income
  FROM orders GROUP BY ALL)
SELECT *, rank() OVER (ORDER BY total_income DESC) AS rank FROM t""")
def income_by_customer_rank(spark: SparkSession, folder: str) -> DataFrame:
    """A rank over as many groups as there are customers, with many ties."""
    rounded = F.round(F.col("o_totalprice") / 10000).cast("decimal(18,0)").alias("total_price")
    orders = table(spark, folder, "orders").select("o_custkey", rounded)
    return reports.income_by_group_ranked(orders, "o_custkey", "total_price", ascending=False)


@query(f"{DAYS} SELECT date, CAST(income AS DECIMAL(28,2)) AS total_income FROM days")
def income_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return reports.income_by_date(_orders(spark, folder), "o_orderdate", "total_price")


@query(f"""{DAYS}
SELECT month, date, CAST(income AS DECIMAL(28,2)) AS total_income,
       CAST(lag(income, 1, 0) OVER (ORDER BY month, date) AS DECIMAL(28,2)) AS prev_income,
       CAST(income - lag(income, 1, 0) OVER (ORDER BY month, date) AS DECIMAL(29,2)) AS profit
FROM days""")
def income_by_date_profit(spark: SparkSession, folder: str) -> DataFrame:
    return reports.income_by_date_with_profit(_orders(spark, folder), "o_orderdate", "total_price")


VS_AVERAGE = """{days}, averaged AS (
  SELECT month, date, CAST(income AS DECIMAL(28,2)) AS total_income,
         CAST({half_up} AS DECIMAL(25,2)) AS avg_month
  FROM days WINDOW w AS ({window}))
SELECT *, total_income >= avg_month AS income_more_than_month_avg FROM averaged"""


@query(VS_AVERAGE.format(days=DAYS, half_up=HALF_UP, window="ORDER BY month"))
def income_vs_month_avg(spark: SparkSession, folder: str) -> DataFrame:
    return reports.income_vs_month_average(_orders(spark, folder), "o_orderdate", "total_price")


@query(VS_AVERAGE.format(days=DAYS, half_up=HALF_UP, window="PARTITION BY year(date), month"))
def income_vs_own_month_avg(spark: SparkSession, folder: str) -> DataFrame:
    return reports.income_vs_month_average(_orders(spark, folder), "o_orderdate", "total_price", per_month=True)


@query("""
SELECT c_mktsegment,
       CASE WHEN c_custkey % 100 >= 60 THEN '60+' WHEN c_custkey % 100 >= 41 THEN '41-60'
            WHEN c_custkey % 100 >= 26 THEN '26-40' WHEN c_custkey % 100 >= 18 THEN '18-25'
            ELSE '1-18' END AS age_group,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_income
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def income_by_segment_age(spark: SparkSession, folder: str) -> DataFrame:
    aged = _spent_with_segment(spark, folder).withColumn("age_group", age_group(F.col("c_custkey") % 100))
    return reports.income_by_groups(aged, ["c_mktsegment", "age_group"], "total_price")
