"""Train/test split and feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PERCENT = 80
SEED = 42
FEATURES = "features"


def split_rows(
    df: DataFrame, key: Sequence[str], train_percent: int = TRAIN_PERCENT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key.

    A row's side depends on its key alone, so it survives re-partitioning,
    retries and later loads of the same table.
    """
    bucket = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(100))
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def scale_columns(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation, measured on ``fit_on``.

    A column without spread keeps a divisor of one.  All statistics come from
    one pass, read back as a one-row scalar subquery.
    """
    measures = []
    for c in columns:
        measures += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_spread")]
    stats = (df if fit_on is None else fit_on).agg(F.struct(*measures).alias("stats")).scalar()
    scaled = {}
    for c in columns:
        spread = stats.getField(f"{c}_spread")
        scaled[c] = (F.col(c) - stats.getField(f"{c}_mean")) / F.when(spread == 0, 1.0).otherwise(spread)
    return df.withColumns(scaled)


def assemble(numeric: Sequence[str], category: str, output: str = FEATURES) -> Pipeline:
    """Numeric columns and a one-hot category as one vector.

    The indexer sorts categories downwards and the encoder drops the last, so
    the alphabetically first category is the one left out.
    """
    index = StringIndexer(inputCol=category, outputCol="_category_index", stringOrderType="alphabetDesc")
    encode = OneHotEncoder(inputCol="_category_index", outputCol="_category_flags", dropLast=True)
    join = VectorAssembler(inputCols=[*numeric, "_category_flags"], outputCol=output)
    return Pipeline(stages=[index, encode, join])
