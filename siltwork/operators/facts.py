"""Fact tables of the shop model and the check on their references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.operators.keys import best_per_key, number_rows


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent; a null key refers to nothing and is left out."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    present = child.where(F.col(child_key).isNotNull())
    return present.join(keys, F.col(child_key) == F.col("_parent_key"), "left_anti")


def latest_products(
    lines: DataFrame, categories: DataFrame, name: str, category: str, attributes: Sequence[str], version: str
) -> DataFrame:
    """One product per name, from its latest line, with a category id and a product id.

    The latest line is chosen among those whose category is known.
    """
    known = categories.select(F.col("id").alias("category_id"), F.col("name").alias("_category"))
    described = lines.join(known, F.col(category) == F.col("_category")).select(
        F.col(name).alias("name"), version, "category_id", *attributes
    )
    newest = best_per_key(described, ["name"], [version]).drop(version)
    return number_rows(newest, ["name"]).select("id", "name", "category_id", *attributes)


def order_headers(
    lines: DataFrame, key: Sequence[str], total: str, order_by: Sequence[str], id_col: str = "id"
) -> DataFrame:
    """One header per key: line count, total and an id in ``order_by`` order."""
    headers = lines.groupBy(*key).agg(
        F.count(key[0]).alias("order_items_amount"), F.sum(total).alias("order_total_price")
    )
    tail = [c for c in key if c not in set(order_by)]
    return number_rows(headers, [*order_by, *tail], id_col)


def attach_headers(lines: DataFrame, headers: DataFrame, key: Sequence[str], id_col: str, as_col: str) -> DataFrame:
    """Each line with the id of its header, joined on the whole header key."""
    ids = headers.select(*key, F.col(id_col).alias(as_col))
    return lines.join(ids, list(key))
