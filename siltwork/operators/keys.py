"""Row choice and surrogate keys.

A row number over a whole table is usually a window without a partition key,
which sends every row to one task.  Here the rows are range-partitioned and
sorted, written once with their place inside the partition, and each place is
shifted by the size of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.shared import write_shared

SLICE, PLACE = "_slice", "_place"
PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above this bit
COPY, COPIES, BLOCK = "_copy", "_copies", "_block"
COPIES_PER_BLOCK = 1_000_000


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def place_in_order(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` written in global order with partition number and row place.

    ``order_by`` must be unique per row: it is what lets a frequent leading
    value spread over several ranges.
    """
    order = _columns(order_by)
    mark = F.col("_mark")
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mark", F.monotonically_increasing_id())
        .withColumn(SLICE, F.shiftright(mark, PLACE_BITS).cast("int"))
        .withColumn(PLACE, mark.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
        .drop("_mark")
    )
    return write_shared(placed, "ordered")


def number_rows(df: DataFrame, order_by: Sequence[str | Column], id_col: str = "id") -> DataFrame:
    """Consecutive ids from 1 in the order given, which must be unique per row.

    The broadcast side has one row per range partition, so its size follows
    the partition count and not the data.
    """
    placed = place_in_order(df, order_by)
    sizes = placed.groupBy(SLICE).agg((F.max(PLACE) + 1).alias("_size"))
    before = F.sum("_size").over(Window.orderBy(SLICE)) - F.col("_size")
    starts = sizes.select(SLICE, before.alias("_start"))
    numbered = placed.join(F.broadcast(starts), SLICE)
    return numbered.select(*df.columns, (F.col("_start") + F.col(PLACE) + 1).alias(id_col))


def tell_copies_apart(df: DataFrame, copy_col: str = COPY) -> DataFrame:
    """Number the copies of identical rows from 1, making every row unique.

    Copies are counted before they move, so a row repeated in a third of the
    table travels as one counted row.  Large groups are unfolded in blocks
    spread over all tasks.
    """
    spark = df.sparkSession
    names = df.columns
    counted = df.groupBy(*names).agg(F.count("*").alias(COPIES))
    few = counted.where(F.col(COPIES) <= COPIES_PER_BLOCK).select(
        *names, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(COPIES))).alias(copy_col)
    )
    block_start = F.col(BLOCK) * COPIES_PER_BLOCK
    last = F.least(block_start + COPIES_PER_BLOCK, F.col(COPIES))
    many = (
        counted.where(F.col(COPIES) > COPIES_PER_BLOCK)
        .withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({COPIES} - 1) div {COPIES_PER_BLOCK}"))))
        # a fixed count: adaptive execution would merge these few short rows again
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), BLOCK, *names)
        .select(*names, F.explode(F.sequence(block_start + 1, last)).alias(copy_col))
    )
    return few.unionByName(many)


def number_all_rows(df: DataFrame, order_by: Sequence[str], id_col: str = "id") -> DataFrame:
    """Like :func:`number_rows` for tables that may hold equal or identical rows.

    Rows equal in ``order_by`` are numbered by their other columns; identical
    rows get consecutive ids.
    """
    rest = [c for c in df.columns if c not in set(order_by)]
    distinct = tell_copies_apart(df)
    return number_rows(distinct, [*order_by, *rest, COPY], id_col).drop(COPY)


def best_per_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], latest: bool = True
) -> DataFrame:
    """One row per key: the last (or first) in ``order_by``, ties by all other columns.

    An aggregate instead of a ranked window: each task reduces its own rows of
    a key before the shuffle, so a frequent key costs one row per task.
    """
    rest = [c for c in df.columns if c not in {*key, *order_by}]
    row = F.struct(*order_by, *rest)
    chosen = (F.max(row) if latest else F.min(row)).alias("_row")
    return df.groupBy(*key).agg(chosen).select(*key, "_row.*").select(*df.columns)


def dimension(df: DataFrame, col: str, name_col: str = "name", id_col: str = "id") -> DataFrame:
    """Distinct values of a column, null included, with ids in value order."""
    names = df.select(F.col(col).alias(name_col)).distinct()
    return number_rows(names, [name_col], id_col).select(id_col, name_col)


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    as_col: str,
    dim_key: str = "name",
    dim_id: str = "id",
    how: str = "left",
) -> DataFrame:
    """Replace nothing, add the dimension's id for the natural key in ``on``."""
    pairs = dim.select(F.col(dim_key).alias("_dim_key"), F.col(dim_id).alias(as_col))
    return df.join(pairs, F.col(on) == F.col("_dim_key"), how).drop("_dim_key")


def rank_rows(
    df: DataFrame, value: str, ascending: bool = False, rank_col: str = "rank"
) -> DataFrame:
    """Rank over the whole table by one column; ties share a rank, gaps follow.

    ``df`` is an aggregated table with unique rows.  The rank of a value is the
    smallest row number among its rows, so no task sees the table whole.
    """
    first = F.col(value).asc() if ascending else F.col(value).desc()
    ties = [c for c in df.columns if c != value]
    numbered = number_rows(df, [first, *ties], "_row")
    ranks = numbered.groupBy(F.col(value).alias("_value")).agg(F.min("_row").alias(rank_col))
    return numbered.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).select(*df.columns, rank_col)
