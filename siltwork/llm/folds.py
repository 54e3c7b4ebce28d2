"""The split by document id that the learned operators share, and bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str) -> Column:
    """True where the CRC-32 of the id as text leaves 1 modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def bounded(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of ``key``: the same rows whatever the partitions."""
    total = rows.count()
    if total <= most:
        return rows
    share = 1_000_000 * most // total
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share)


def bounded_distinct(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows at most, no two of them equal, chosen by a hash of the whole row.

    Every group of equal rows is in the sample as one row or not at all, so a group that holds a third of the table weighs no
    more than any other.  Tasks drop repeats before anything moves.
    """
    mark = "__sw_mark"
    marked = rows.withColumn(mark, F.xxhash64(*rows.columns))
    different = marked.agg(F.approx_count_distinct(mark, 0.01)).first()[0]
    if different > most:
        marked = marked.where(F.pmod(F.col(mark), F.lit(1_000_000)) < 1_000_000 * most // different)

    def first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of about ``most`` different rows at most
        for batch in batches:
            fresh = []
            for at, value in enumerate(batch.column(mark).to_pylist()):
                if value not in seen:
                    seen.add(value)
                    fresh.append(at)
            yield batch.take(pa.array(np.array(fresh, np.int64)))

    return marked.mapInArrow(first_of_task, marked.schema).dropDuplicates([mark]).drop(mark)
