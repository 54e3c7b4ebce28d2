"""Card charges: averages, merges, CSV loads, features and models."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.learning.features import assemble, scale_columns, split_rows
from siltwork.learning.models import FeatureSet, fit_all, predictions, r_squared, ridge_penalty, scores, weights
from siltwork.operators.keyed import KeyedTable
from siltwork.operators.merge import insert_ignore, upsert
from siltwork.plans import finance
from siltwork.plans.tables import TRAINING
from siltwork.queries import inputs
from siltwork.queries.inputs import SETTLED_SQL, UUID_SQL
from siltwork.queries.registry import query, table
from siltwork.shared import shared_path
from siltwork.sources.files import read_csv_split, route_by_path
from siltwork.sources.landing import archive_folder, stream_landing
from siltwork.streaming.batches import staged_sink
from siltwork.streaming.queries import run_available

AVERAGES = f"""WITH {SETTLED_SQL}, averages AS (
  SELECT customer_no, SUM(amount_captured) AS total, COUNT(*) AS n
  FROM charges WHERE status = 'succeeded' AND outcome_network_status = 'approved_by_network' AND paid
  GROUP BY customer_no
), settled AS (
  SELECT customer_no,
         CAST(CAST((200 * total + n) // (2 * n) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(16,2))
           AS avg_amount_captured
  FROM averages
)"""

SATISFACTION_SQL = f"""
satisfaction AS (
  SELECT c_custkey AS customer_no, {UUID_SQL.format('c_custkey')} AS customer_id,
         CAST(c_custkey % 11 AS INTEGER) AS customer_satisfaction_speed,
         CAST(c_custkey * 3 % 11 AS INTEGER) AS customer_satisfaction_product,
         CAST(c_custkey * 7 % 11 AS INTEGER) AS customer_satisfaction_service,
         CASE WHEN c_custkey % 2 = 0 THEN 'product_A' ELSE 'product_B' END AS product_type
  FROM customer
)"""

FEATURES_SQL = f"""{AVERAGES}, {SATISFACTION_SQL}, features AS (
  SELECT DISTINCT customer_id, customer_satisfaction_speed, customer_satisfaction_product,
         customer_satisfaction_service, product_type, avg_amount_captured
  FROM satisfaction JOIN settled USING (customer_no))"""


@query(f"{AVERAGES} SELECT {UUID_SQL.format('customer_no')} AS customer_id, avg_amount_captured FROM settled")
def charge_averages(spark: SparkSession, folder: str) -> DataFrame:
    return finance.captured_averages(inputs.charges(spark, folder))


@query(f"{FEATURES_SQL} SELECT * FROM features")
def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return finance.training_rows(inputs.charges(spark, folder), inputs.satisfaction(spark, folder))


TRAINING_SQL = f"""{FEATURES_SQL}, stored AS (
  SELECT customer_id, 0 AS customer_satisfaction_speed, 0 AS customer_satisfaction_product,
         0 AS customer_satisfaction_service, product_type, CAST(0 AS DECIMAL(16,2)) AS avg_amount_captured
  FROM satisfaction WHERE customer_no % 3 = 0)
SELECT * FROM features
UNION ALL SELECT * FROM stored WHERE customer_id NOT IN (SELECT customer_id FROM features)"""


@query(TRAINING_SQL)
def training_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The upsert into a training table that already holds a third of the customers."""
    satisfaction = inputs.satisfaction(spark, folder)
    zeros = {name: F.lit(0) for name in finance.SCORES}
    stored = satisfaction.where("CAST(right(customer_id, 12) AS BIGINT) % 3 = 0").withColumns(
        {**zeros, "avg_amount_captured": F.lit(0).cast("decimal(16,2)")}
    )
    return finance.refresh_training(stored, inputs.charges(spark, folder), satisfaction)


@query(TRAINING_SQL)
def training_refresh_in_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert into a stored table: the first third of the customers, then all with settled charges."""
    satisfaction, charges = inputs.satisfaction(spark, folder), inputs.charges(spark, folder)
    path = shared_path(spark, "training")
    zeros = {name: F.lit(0) for name in finance.SCORES}
    stored = satisfaction.where("CAST(right(customer_id, 12) AS BIGINT) % 3 = 0").withColumns({**zeros, "avg_amount_captured": F.lit(0).cast("decimal(16,2)")})
    columns = finance.training_rows(charges, satisfaction).columns
    KeyedTable(spark, path, ["customer_id"]).upsert(stored.select(*columns))
    return finance.refresh_training_in(path, charges, satisfaction)


@query("""
WITH source AS (SELECT o_custkey AS id, o_orderstatus AS label, o_totalprice AS value,
                       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n
                FROM orders WHERE o_custkey % 3 = 0)
SELECT id, label, value FROM source WHERE n = 1
UNION ALL
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
WHERE c_custkey % 2 = 0 AND c_custkey NOT IN (SELECT id FROM source)""", name="upsert")
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Source keys repeat: the last order of a customer wins."""
    target = table(spark, folder, "customer").where("c_custkey % 2 = 0").selectExpr(
        "CAST(NULL AS BIGINT) AS version", "c_custkey AS id", "c_mktsegment AS label", "c_acctbal AS value"
    )
    source = table(spark, folder, "orders").where("o_custkey % 3 = 0").selectExpr(
        "o_orderkey AS version", "o_custkey AS id", "o_orderstatus AS label", "o_totalprice AS value"
    )
    return upsert(target, source, ["id"], ["version"]).select("id", "label", "value")


@query("""
WITH source AS (SELECT o_orderkey AS version, o_custkey AS id, o_orderstatus AS label, o_totalprice AS value,
                       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n
                FROM orders WHERE o_custkey % 3 = 0)
SELECT NULL AS version, c_custkey AS id, c_mktsegment AS label, c_acctbal AS value FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT version, id, label, value FROM source
WHERE n = 1 AND id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""", name="insert_ignore")
def insert_ignored(spark: SparkSession, folder: str) -> DataFrame:
    """Only customers that are not stored yet; their first order wins."""
    target = table(spark, folder, "customer").where("c_custkey % 2 = 0").selectExpr(
        "CAST(NULL AS BIGINT) AS version", "c_custkey AS id", "c_mktsegment AS label", "c_acctbal AS value"
    )
    source = table(spark, folder, "orders").where("o_custkey % 3 = 0").selectExpr(
        "o_orderkey AS version", "o_custkey AS id", "o_orderstatus AS label", "o_totalprice AS value"
    )
    return insert_ignore(target, source, ["id"], ["version"])


def _landed(spark: SparkSession, folder: str) -> str:
    """Charges and satisfaction as landed CSV files, one folder each."""
    base = shared_path(spark, "landing")
    inputs.charges(spark, folder).write.option("header", True).csv(f"{base}/charge")
    inputs.satisfaction(spark, folder).write.option("header", True).csv(f"{base}/satisfaction")
    return base


@query(f"{FEATURES_SQL} SELECT * FROM features")
def csv_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Landing files, read under contract, to the feature table."""
    loaded = finance.load_folders(spark, _landed(spark, folder))
    return finance.training_rows(loaded["in_charge"], loaded["customer_satisfaction"])


@query("""
SELECT 'in_charge' AS target_table, COUNT(*) AS amount FROM orders
UNION ALL SELECT 'customer_satisfaction', COUNT(*) FROM customer""")
def csv_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per target table, told apart by the folder of their file."""
    landed = spark.read.text(f"{_landed(spark, folder)}/*/*.csv")
    rows = route_by_path(landed, {"charge/": "in_charge"}, "customer_satisfaction")
    return rows.where(~F.col("value").rlike("^(id|customer_id),")).groupBy("target_table").agg(
        F.count("*").alias("amount")
    )


@query(f"""
SELECT {UUID_SQL.format('c_custkey')} AS customer_id,
       concat_ws(';', CASE WHEN c_custkey % 5 = 0 THEN 'customer_satisfaction_speed:type' END,
                      CASE WHEN c_custkey % 4 = 0 THEN 'product_type:not_null' END,
                      CASE WHEN c_custkey % 9 = 0 THEN 'avg_amount_captured:type' END) AS reasons
FROM customer""")
def csv_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Broken fields of a CSV file by row: bad number, missing text, decimal too long."""
    path = shared_path(spark, "faulty")
    faulty = inputs.satisfaction(spark, folder).withColumn("n", F.expr("CAST(right(customer_id, 12) AS BIGINT)"))
    faulty.selectExpr(
        "customer_id",
        "CASE WHEN n % 5 = 0 THEN 'many' ELSE CAST(customer_satisfaction_speed AS STRING) END AS customer_satisfaction_speed",
        "customer_satisfaction_product",
        "customer_satisfaction_service",
        "CASE WHEN n % 4 = 0 THEN NULL ELSE product_type END AS product_type",
        "CASE WHEN n % 9 = 0 THEN '123456789012345.10' ELSE '10.50' END AS avg_amount_captured",
    ).write.option("header", True).csv(path)
    good, bad = read_csv_split(spark, path, TRAINING)
    return good.select("customer_id", F.lit("").alias("reasons")).unionAll(
        bad.select("customer_id", F.concat_ws(";", "violations"))
    )


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def ingest_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files as a stream, archived, staged by batch."""
    base = shared_path(spark, "ingest")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    orders.repartition(4).write.option("header", True).csv(f"{base}/new")
    files = stream_landing(
        spark, f"{base}/new", orders.schema, archive_folder(f"{base}/archive", dt.date(2024, 9, 4)),
        max_files_per_batch=1,
    )
    run_available(files, staged_sink(f"{base}/staged"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/staged").select(*orders.columns)


NUMBERS = ("c_acctbal", "c_custkey", "c_nationkey")


@query("""
SELECT c_name, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) AS c_acctbal,
       round((c_custkey - avg(c_custkey) OVER ()) / stddev_pop(c_custkey) OVER (), 6) AS c_custkey,
       round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_pop(c_nationkey) OVER (), 6) AS c_nationkey
FROM customer""")
def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    scaled = scale_columns(table(spark, folder, "customer"), NUMBERS)
    return scaled.select("c_name", *(F.round(c, 6).alias(c) for c in NUMBERS))


@query("""
SELECT c_custkey, c_acctbal, CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS machinery,
       CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS household, CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS furniture,
       CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS building
FROM customer""")
def one_hot_features(spark: SparkSession, folder: str) -> DataFrame:
    """The vector taken apart again: the alphabetically first segment is all zeros."""
    customers = table(spark, folder, "customer")
    rows = assemble(["c_acctbal"], "c_mktsegment").fit(customers).transform(customers)
    parts = vector_to_array("features")
    names = ("machinery", "household", "furniture", "building")
    return rows.select(
        "c_custkey", parts[0].alias("c_acctbal"), *(parts[i + 1].cast("int").alias(n) for i, n in enumerate(names))
    )


@query("SELECT c_custkey FROM customer")
def train_and_test_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The two sides of the split together are the table."""
    train, test = split_rows(table(spark, folder, "customer"), ["c_custkey"])
    return train.unionByName(test).select("c_custkey")


@query("""
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 4) AS r2
FROM lineitem""")
def linreg_fit(spark: SparkSession, folder: str) -> DataFrame:
    """One feature: slope, intercept and R² of the fitted line."""
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    )
    model = LinearRegression(labelCol="l_extendedprice", regParam=0.0, solver="normal").fit(rows)
    fitted = r_squared(model.transform(rows), "l_extendedprice")
    return fitted.select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
        F.round("r2", 4).alias("r2"),
    )


@query("""
SELECT l_returnflag,
       round(1 - sum((l_extendedprice - l_quantity * 1500) * (l_extendedprice - l_quantity * 1500))
                 / (var_pop(l_extendedprice) * count(l_extendedprice)), 6) AS r2
FROM lineitem GROUP BY ALL""")
def r2_by_group(spark: SparkSession, folder: str) -> DataFrame:
    """R² of a fixed guess, per group."""
    guessed = table(spark, folder, "lineitem").withColumn("prediction", F.col("l_quantity") * 1500)
    return r_squared(guessed, "l_extendedprice", by=["l_returnflag"]).select("l_returnflag", F.round("r2", 6).alias("r2"))


def _compared(spark: SparkSession, folder: str) -> finance.Comparison:
    training = finance.training_rows(inputs.charges(spark, folder), inputs.satisfaction(spark, folder))
    return finance.compare_models(training, trees=20)


@query()
def models_compare(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder).scores


@query()
def model_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder).weights


@query()
def model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """True against predicted value of every row under every model."""
    return _compared(spark, folder).predictions


TWO_FEATURES = """
WITH m AS (
  SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice) AS my,
         var_pop(l_quantity) * count(*) AS xx, var_pop(l_discount) * count(*) AS zz, covar_pop(l_quantity, l_discount) * count(*) AS xz,
         covar_pop(l_quantity, l_extendedprice) * count(*) AS xy, covar_pop(l_discount, l_extendedprice) * count(*) AS zy
  FROM lineitem WHERE l_orderkey % 5 <> 0),
fits AS (SELECT *, ((zz + alpha) * xy - xz * zy) / ((xx + alpha) * (zz + alpha) - xz * xz) AS bx,
                ((xx + alpha) * zy - xz * xy) / ((xx + alpha) * (zz + alpha) - xz * xz) AS bz
         FROM m, (SELECT 'LinearRegression' AS model, 0.0 AS alpha UNION ALL SELECT 'Ridge', 10.0)),
predicted AS (SELECT model, CASE WHEN l_orderkey % 5 <> 0 THEN 'train' ELSE 'test' END AS side, l_extendedprice AS y,
                     my + bx * (l_quantity - mx) + bz * (l_discount - mz) AS p
              FROM lineitem, fits)
"""


def _two_features(spark: SparkSession, folder: str):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice")
    names = ["l_quantity", "l_discount"]
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(lines)
    train, test = rows.where("l_orderkey % 5 <> 0"), rows.where("l_orderkey % 5 = 0")
    features = FeatureSet(train, test, names, "l_extendedprice")
    spread, count = train.agg(F.stddev_pop("l_extendedprice"), F.count("*")).first()
    plain = {"featuresCol": "features", "labelCol": "l_extendedprice", "standardization": False, "solver": "normal"}
    fitted = fit_all(features, {
        "LinearRegression": LinearRegression(regParam=0.0, **plain),
        "Ridge": LinearRegression(regParam=ridge_penalty(10.0, spread, count), elasticNetParam=0.0, **plain),
    })
    return lines, features, fitted


@query(f"""{TWO_FEATURES}
SELECT model, side, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 5) AS r2 FROM predicted GROUP BY model, side""")
def linear_models_scored(spark: SparkSession, folder: str) -> DataFrame:
    """R² of least squares and ridge on the rows they were fitted on and on the others."""
    _, features, fitted = _two_features(spark, folder)
    return scores(predictions(features, fitted)).select("model", "side", F.round("r2", 5).alias("r2"))


@query(f"""{TWO_FEATURES}
SELECT model, 'l_quantity' AS feature, round(bx, 3) AS weight FROM fits UNION ALL SELECT model, 'l_discount', round(bz, 3) FROM fits""")
def linear_models_weighed(spark: SparkSession, folder: str) -> DataFrame:
    lines, features, fitted = _two_features(spark, folder)
    return weights(lines, features, fitted).withColumn("weight", F.round("weight", 3))


@query(f"{TWO_FEATURES} SELECT model, side, y AS true_value, round(p, 2) AS predicted_value FROM predicted WHERE model = 'Ridge'")
def ridge_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """The true value of every row beside what ridge regression says."""
    _, features, fitted = _two_features(spark, folder)
    found = predictions(features, {"Ridge": fitted["Ridge"]})
    return found.withColumn("predicted_value", F.round("predicted_value", 2))
