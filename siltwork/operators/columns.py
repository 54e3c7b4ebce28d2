"""Column-level table work: type repair, shaping, key lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repair_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; text that does not fit becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def shape(
    df: DataFrame, rename: Mapping[str, str] | None = None, drop: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """Rename, drop and reorder in one projection.

    ``order`` uses the new names and puts its columns first.
    """
    rename = rename or {}
    kept = {rename.get(name, name): F.col(name) for name in df.columns if name not in set(drop)}
    names = [*order, *(name for name in kept if name not in set(order))]
    return df.select(*(kept[name].alias(name) for name in names))


def lift_fields(df: DataFrame, struct_col: str, fields: Sequence[str]) -> DataFrame:
    """Fields of a struct as columns in place of the struct."""
    others = [F.col(c) for c in df.columns if c != struct_col]
    return df.select(*others, *(F.col(struct_col).getField(f).alias(f) for f in fields))


def keep_listed(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``: the distributed form of an IN list."""
    names = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*names), names, "left_semi")


def union_renamed(first: DataFrame, second: DataFrame, rename: Mapping[str, str]) -> DataFrame:
    """Union that keeps duplicates, after renaming columns of ``second``."""
    return first.unionByName(shape(second, rename=rename))


def order_by_list(col: Column, values: Sequence[str]) -> Column:
    """Sort key that follows ``values``; anything else comes last."""
    place = F.array_position(F.array(*(F.lit(v) for v in values)), col)
    return F.coalesce(F.nullif(place, F.lit(0)), F.lit(len(values) + 1))
