"""Declared rules over orders, lines and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.operators.contracts import Check, Contract, Field, duplicate_keys
from siltwork.queries.registry import query, table

# Bounds tight enough that every rule is broken somewhere in the table.
LINE_RULES = Contract(
    fields=(
        Field("l_orderkey", "long", required=True),
        Field("l_linenumber", "integer", required=True),
        Field("l_quantity", "decimal(3,1)", required=True),
        Field("l_extendedprice", "decimal(7,2)"),
        Field("l_returnflag", max_length=1),
        Field("remark", required=True, max_length=12),
    ),
    checks=(
        Check("quantity", lambda c: c("l_quantity") <= 45),
        Check("price", lambda c: c("l_extendedprice") >= 1000),
    ),
    unique=("l_orderkey", "l_linenumber"),
)

REMARK = "CASE WHEN l_linenumber = 3 THEN NULL ELSE {} END"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    remark = REMARK.format("concat('line ', l_orderkey, '/', l_linenumber)")
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", f"{remark} AS remark"
    )


BROKEN = f"""WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
         {REMARK.format("'line ' || l_orderkey || '/' || l_linenumber")} AS remark
  FROM lineitem
), checked AS (
  SELECT *, concat_ws(';',
    CASE WHEN l_extendedprice >= 99999.995 THEN 'l_extendedprice:type' END,
    CASE WHEN remark IS NULL THEN 'remark:not_null' END,
    CASE WHEN length(remark) > 12 THEN 'remark:length' END,
    CASE WHEN l_quantity > 45 THEN 'quantity:check' END,
    CASE WHEN l_extendedprice < 1000 THEN 'price:check' END) AS reasons
  FROM lines
)"""


@query(f"{BROKEN} SELECT l_orderkey, l_linenumber, reasons FROM checked WHERE reasons <> ''")
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = LINE_RULES.split(_lines(spark, folder))
    return bad.select("l_orderkey", "l_linenumber", F.concat_ws(";", "violations").alias("reasons"))


@query(f"""{BROKEN}
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(3,1)) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(7,2)) AS l_extendedprice, l_returnflag, remark
FROM checked WHERE reasons = ''""")
def contract_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that pass, in the declared types."""
    good, _ = LINE_RULES.split(_lines(spark, folder))
    return good


@query(f"""{BROKEN}, reasons AS (SELECT unnest(string_split(reasons, ';')) AS rule FROM checked WHERE reasons <> '')
SELECT rule, COUNT(*) AS amount FROM reasons GROUP BY ALL""")
def contract_summary(spark: SparkSession, folder: str) -> DataFrame:
    return LINE_RULES.count_violations(_lines(spark, folder))


@query("""
SELECT l_orderkey, l_linenumber, COUNT(*) AS amount FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1""")
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return LINE_RULES.duplicate_keys(table(spark, folder, "lineitem"))


@query("SELECT p_name, COUNT(*) AS amount FROM part GROUP BY ALL HAVING COUNT(*) > 1")
def repeated_names(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "part"), ["p_name"])


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS note, 'uploaded' AS status FROM customer")
def defaults_filled(spark: SparkSession, folder: str) -> DataFrame:
    """A default fills the absent column and leaves the nulls of a present one."""
    rules = Contract(
        fields=(
            Field("c_custkey", "long"),
            Field("note", default=lambda: F.lit("none")),
            Field("status", default=lambda: F.lit("uploaded")),
        )
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey", "c_name", "CASE WHEN c_custkey % 2 = 0 THEN c_name END AS note"
    )
    return rules.fill_absent(customers)


@query("SELECT o_orderkey, o_custkey FROM orders")
def contract_enforced(spark: SparkSession, folder: str) -> DataFrame:
    """A table that keeps its contract passes through unchanged."""
    rules = Contract(fields=(Field("o_orderkey", "long", required=True), Field("o_custkey", "long", required=True)))
    return rules.enforce(table(spark, folder, "orders").select("o_orderkey", "o_custkey"))
