"""Upserts, insert-or-ignore and the ledger of processed rows, on whole tables.

:mod:`siltwork.operators.keyed` has the same over a table whose untouched buckets stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.operators.keys import best_per_key
from siltwork.published import publish

__all__ = ["insert_ignore", "mark_processed", "one_per_key", "publish", "unprocessed", "upsert"]


def _null_key(key: Sequence[str]) -> Column:
    return reduce(or_, (F.col(name).isNull() for name in key))


def one_per_key(
    source: DataFrame, key: Sequence[str], order_by: Sequence[str], latest: bool, on_duplicate: str = "choose"
) -> DataFrame:
    """``source`` with unique keys; rows with a null key never conflict and all stay.

    ``on_duplicate="fail"`` makes the job fail on a repeated key instead.
    """
    keyed, unkeyed = source.where(~_null_key(key)), source.where(_null_key(key))
    if on_duplicate == "fail":
        repeated = F.col("_copies") > 1
        counted = keyed.groupBy(*key).agg(F.count("*").alias("_copies")).where(
            F.when(repeated, F.raise_error(F.lit("key repeated in source")).cast("boolean")).otherwise(True)
        )
        chosen = keyed.join(counted.select(*key), list(key))
    elif on_duplicate == "choose":
        chosen = best_per_key(keyed, key, order_by, latest)
    else:
        raise ValueError("on_duplicate must be 'choose' or 'fail'")
    return chosen.unionByName(unkeyed.select(*chosen.columns)).select(*source.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    on_duplicate: str = "choose",
) -> DataFrame:
    """Target rows not named by the source, and every source row.

    When the source repeats a key its last row in ``order_by`` is used.
    """
    incoming = one_per_key(source, key, order_by, latest=True, on_duplicate=on_duplicate)
    kept = target.join(incoming.select(*key), list(key), "left_anti")
    return kept.unionByName(incoming)


def insert_ignore(
    target: DataFrame, source: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Every target row, and source rows with a new key; the first arrival wins."""
    incoming = one_per_key(source, key, order_by, latest=False)
    fresh = incoming.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def mark_processed(
    rows: DataFrame, ledger: DataFrame, key: str, status_col: str = "status", status: str = "transformed"
) -> DataFrame:
    """``rows`` with the status of those named in the ledger changed."""
    done = ledger.select(F.col(key).alias("_done")).distinct()
    joined = rows.join(done, F.col(key) == F.col("_done"), "left")
    marked = F.when(F.col("_done").isNotNull(), status).otherwise(F.col(status_col))
    return joined.withColumn(status_col, marked).select(*rows.columns)


def unprocessed(rows: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows not named in the ledger."""
    return rows.join(ledger.select(key), key, "left_anti").select(*rows.columns)
