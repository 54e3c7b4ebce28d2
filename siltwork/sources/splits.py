"""Ranges of a column that hold about as many rows each, for parallel scans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.sources.jdbc import read_table

ACCURACY = 10_000


def literal(value: object) -> str:
    """A value as a literal that Spark and common databases read alike."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    text = str(value).replace("'", "''")
    return f"'{text}'"


def plan_splits(rows: DataFrame, column: str, splits: int, accuracy: int = ACCURACY, quoted: str | None = None) -> list[str]:
    """Predicates over ``column`` of which each row meets one: about ``splits`` ranges of equal depth.

    The bounds are quantiles of a mergeable sketch, one row to the driver; ``accuracy`` sets its error to rows /
    ``accuracy``.  A value that holds more than a range's share of the rows comes back as several quantiles and
    gets a range of its own, which no range can divide.  Null values go with the first range.
    ``quoted`` is the column's name as the database writes it.
    """
    if splits < 1:
        raise ValueError("splits must be 1 or more")
    name = quoted or column
    col = F.col(column)
    kind = rows.schema[column].dataType.typeName()
    if kind == "string":
        raise ValueError("quantiles need numbers, dates or timestamps")
    plain = col.cast("timestamp") if kind == "timestamp_ntz" else col
    shares = [k / splits for k in range(1, splits)]
    points = rows.agg(F.percentile_approx(plain, shares, accuracy)).first()[0] if shares else None
    if not points:
        return ["1 = 1"]
    bounds = sorted(set(points))
    heavy = {p for p, q in zip(points, points[1:]) if p == q}
    cuts: list[tuple[str, object]] = []  # where ranges begin: at a bound, or after a heavy value
    for bound in bounds:
        cuts.append((">=", bound))
        if bound in heavy:
            cuts.append((">", bound))
    other = {">=": "<", ">": "<="}
    first_sign, first = cuts[0]
    predicates = [f"({name} {other[first_sign]} {literal(first)} OR {name} IS NULL)"]
    for (sign, low), (next_sign, high) in zip(cuts, cuts[1:]):
        predicates.append(f"{name} {sign} {literal(low)} AND {name} {other[next_sign]} {literal(high)}")
    predicates.append(f"{name} {cuts[-1][0]} {literal(cuts[-1][1])}")
    return predicates


def read_evenly(
    spark: SparkSession, url: str, table: str, column: str, splits: int, properties: Mapping[str, str] | None = None
) -> DataFrame:
    """A JDBC table in ranges of equal depth: one scan of the column alone plans them, one task reads each."""
    narrow = read_table(spark, url, table, properties=properties).select(column)
    return read_table(spark, url, table, predicates=plan_splits(narrow, column, splits), properties=properties)
