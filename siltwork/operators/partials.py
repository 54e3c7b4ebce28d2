"""Reports that are refreshed from new data only.

Rows land in a day table: a published table with a part for each day (or month).  Beside it stand partial aggregates,
one row for each group of a day.  A refresh compares the folders the day table names now with those the partials were
made of, reads the parts that differ, and replaces their partials; a report merges partials and reads no row of the day table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.money import exact_average
from siltwork.published import Published

DAY = "day"

# How a measure is taken from rows, and how its partials are merged.
TAKEN = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


class DayTable:
    """Rows by the day of ``stamp``, or by its ``unit`` (week, month, year); rows without one share a part of their own."""

    def __init__(self, spark: SparkSession, path: str, stamp: str, unit: str = "day"):
        self.table, self.stamp, self.unit = Published(spark, path), stamp, unit

    def part(self, day: Column) -> Column:
        return F.to_date(F.date_trunc(self.unit, day))

    def append(self, rows: DataFrame, batch_id: int | None = None) -> bool:
        """Add rows under their days; False, and nothing added, where ``batch_id`` was added before."""
        held = self.table.manifest()
        done = held.notes.get("batch_id", -1) if held else -1
        if batch_id is not None and batch_id <= done:
            return False
        self.table.append(rows, self.part(F.col(self.stamp)), batch_id=done if batch_id is None else batch_id)
        return True

    def read(self) -> DataFrame:
        return self.table.read()


class Partials:
    """Partial aggregates of a day table by ``grain``, kept at ``path``.

    ``measures`` names each measure's kind (``count``, ``sum``, ``min`` or ``max``) and what it is taken of.
    """

    def __init__(self, spark: SparkSession, path: str, grain: Mapping[str, Column], measures: Mapping[str, tuple[str, Column]]):
        self.table, self.grain, self.measures = Published(spark, path), dict(grain), dict(measures)

    def refresh(self, source: DayTable) -> list[str]:
        """Bring the partials up to the latest version of ``source``; the parts that were read for it.

        What the partials were made of is committed with them, so a refresh that is lost is made again in full.
        """
        now, held = source.table.manifest(), self.table.manifest()
        if now is None:
            return []
        seen = held.notes["made_of"] if held else {}
        changed = [day for day, folders in now.parts.items() if seen.get(day) != folders]
        gone = [day for day in seen if day not in now.parts]
        if held and not changed and not gone:
            return []
        rows = source.table.read_parts(now, changed)
        day = F.to_date(F.col(source.stamp)).alias(DAY)
        grain = [column.alias(name) for name, column in self.grain.items()]
        taken = [TAKEN[kind](column).alias(name) for name, (kind, column) in self.measures.items()]
        made = rows.groupBy(day, *grain).agg(*taken)
        parts, counts = self.table.stage(made, source.part(F.col(DAY)))
        kept = {d: f for d, f in (held.parts if held else {}).items() if d not in gone}
        kept_counts = {d: n for d, n in (held.rows if held else {}).items() if d not in gone}
        self.table.commit(held, made.schema, {**kept, **parts}, {**kept_counts, **counts}, {"made_of": now.parts})
        return changed

    def read(self) -> DataFrame:
        """One row for each group of a day."""
        return self.table.read()

    def merged(self, by: Sequence[str | Column], measures: Sequence[str] | None = None) -> DataFrame:
        """Measures by any columns of the grain and ``day``, or by expressions over them, from the partials alone."""
        names = list(measures or self.measures)
        return self.read().groupBy(*by).agg(*(MERGED[self.measures[name][0]](name).alias(name) for name in names))

    def average(self, by: Sequence[str | Column], total: str, count: str, as_col: str) -> DataFrame:
        """The average over rows, not over days: sums and counts are merged before they are divided."""
        both = self.merged(by, [total, count])
        return both.withColumn(as_col, exact_average(F.col(total), F.col(count))).drop(total, count)
