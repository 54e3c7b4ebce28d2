"""Declared table rules, checked by Spark because it enforces none itself.

One narrow pass computes the list of broken rules per row; loading, quarantine
and reporting all start from that list.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A condition that is true for a broken row, and the name it is reported under.
Rule = tuple[Column, str]

VIOLATIONS = "violations"
UUID = "uuid"
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


@dataclass(frozen=True)
class Field:
    """One column: type, null rule, text length and value when the column is absent."""

    name: str
    kind: str = "string"
    required: bool = False
    max_length: int | None = None
    default: Callable[[], Column] | None = None

    @property
    def spark_type(self) -> str:
        return "string" if self.kind == UUID else self.kind

    def typed(self) -> Column:
        """The column in its declared type, null where the text does not fit it."""
        return F.col(self.name).try_cast(self.spark_type)

    def rules(self) -> list[Rule]:
        """Conditions under which this column breaks its declaration."""
        col = F.col(self.name)
        found = []
        if self.required:
            found.append((col.isNull(), f"{self.name}:not_null"))
        if self.kind == UUID:
            found.append((~col.rlike(UUID_PATTERN), f"{self.name}:type"))
        elif self.kind != "string":
            found.append((col.isNotNull() & self.typed().isNull(), f"{self.name}:type"))
        if self.max_length is not None:
            found.append((F.length(col) > self.max_length, f"{self.name}:length"))
        return found


@dataclass(frozen=True)
class Check:
    """A named boolean rule; null passes, as a SQL CHECK does."""

    name: str
    rule: Callable[[Callable[[str], Column]], Column]


@dataclass(frozen=True)
class Contract:
    fields: Sequence[Field]
    checks: Sequence[Check] = ()
    unique: Sequence[str] = ()

    def schema(self) -> StructType:
        schema = StructType()
        for field in self.fields:
            schema.add(field.name, field.spark_type)
        return schema

    def column(self, name: str) -> Column:
        return next(f for f in self.fields if f.name == name).typed()

    def rules(self) -> list[Rule]:
        found = [rule for field in self.fields for rule in field.rules()]
        return found + [(~check.rule(self.column), f"{check.name}:check") for check in self.checks]

    def with_violations(self, df: DataFrame, extra: Sequence[Rule] = ()) -> DataFrame:
        """``df`` plus an array of the rules each row breaks."""
        return df.select("*", _names([*self.rules(), *extra]).alias(VIOLATIONS))

    def split(self, df: DataFrame, extra: Sequence[Rule] = ()) -> tuple[DataFrame, DataFrame]:
        """Typed rows that keep every rule, and the others untouched with their violations.

        Rows are told apart by a plain boolean; names are gathered for broken
        rows only.
        """
        broken = _any([*self.rules(), *extra])
        return self.conform(df.where(~broken)), self.with_violations(df.where(broken), extra)

    def enforce(self, df: DataFrame) -> DataFrame:
        """``df`` unchanged; the job that reads it fails on the first broken row."""
        message = F.concat(F.lit("contract broken: "), F.concat_ws(", ", _names(self.rules())))
        fails = F.raise_error(message).cast("boolean")
        return df.where(F.when(_any(self.rules()), fails).otherwise(True))

    def count_violations(self, df: DataFrame) -> DataFrame:
        """Broken rules with their row counts, from one pass that moves one row per task."""
        rules = self.rules()
        totals = df.agg(*(F.count_if(broken).alias(f"_{i}") for i, (broken, _) in enumerate(rules)))
        pairs = (F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("amount")) for i, (_, name) in enumerate(rules))
        return totals.select(F.inline(F.array(*pairs))).where("amount > 0")

    def conform(self, df: DataFrame) -> DataFrame:
        """Declared columns in declared order and type."""
        return df.select(*(f.typed().alias(f.name) for f in self.fields))

    def fill_absent(self, df: DataFrame) -> DataFrame:
        """Add columns that are missing and have a default; explicit nulls stay."""
        missing = {f.name: f.default() for f in self.fields if f.default and f.name not in df.columns}
        return df.withColumns(missing) if missing else df

    def duplicate_keys(self, df: DataFrame) -> DataFrame:
        return duplicate_keys(df, self.unique)


def _any(rules: Sequence[Rule]) -> Column:
    return reduce(or_, (F.coalesce(broken, F.lit(False)) for broken, _ in rules), F.lit(False))


def _names(rules: Sequence[Rule]) -> Column:
    return F.array_compact(F.array(*(F.when(broken, name) for broken, name in rules)))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count; nulls are no duplicates."""
    present = df.dropna(subset=list(key))
    return present.groupBy(*key).agg(F.count("*").alias("amount")).where("amount > 1")
