"""Amounts: decimals, line totals, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(10,2)"
AMOUNT = "decimal(18,2)"


def amount(col: Column, kind: str = AMOUNT) -> Column:
    return col.cast(kind)


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price; null when either is null."""
    return (quantity * unit_price).cast(PRICE)


def total_differs(quantity: Column, unit_price: Column, total: Column) -> Column:
    """True where the stored total is not quantity times price."""
    return F.coalesce(line_total(quantity, unit_price) != total, F.lit(False))


def exact_average(total: Column, count: Column) -> Column:
    """Average rounded half up to two places.

    The quotient keeps 15 decimals, so the first rounding cannot tip the second
    one; Spark's own decimal average keeps only four more than its input.
    """
    return F.round(F.try_divide(total.cast("decimal(25,2)"), count.cast("decimal(13,0)")), 2).cast("decimal(25,2)")


def share_percent(value: Column, total: Column) -> Column:
    """``value`` as a percentage of ``total``, two decimals; null for a zero total."""
    return F.round(F.try_divide(value, total) * 100, 2)
