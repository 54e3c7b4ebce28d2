"""JSON messages: decode bytes to typed columns, flatten records, encode rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from siltwork.functions.dates import STAMP_FORMAT
from siltwork.functions.text import joined

CORRUPT = "_corrupt_record"


def message_text(value: Column) -> Column:
    """Message bytes as text."""
    return value.cast("string")


def decode_messages(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    stamp_format: str = STAMP_FORMAT,
    keep_corrupt: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One typed row per message, on a batch or a stream; ``keep`` names columns to carry along.

    Text that is not JSON gives a row of nulls and a bad field gives null for
    that field alone.  ``keep_corrupt`` adds ``_corrupt_record`` with the
    original text of both kinds, for a quarantine table.
    """
    wanted = schema
    if keep_corrupt:
        wanted = StructType(list(schema.fields)).add(CORRUPT, StringType())
    options = {"mode": "PERMISSIVE", "timestampFormat": stamp_format, "columnNameOfCorruptRecord": CORRUPT}
    data = F.from_json(message_text(F.col(value_col)), wanted, options)
    return df.select(data.alias("data"), *keep).select("data.*", *keep)


def message_id(value: Column) -> Column:
    """UUID-shaped id from the message text: a replayed message keeps its id."""
    return F.regexp_replace(F.md5(value.cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def encode_rows(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """Each row as one JSON text in ``value``, with an optional ``key``."""
    value = F.to_json(F.struct("*")).alias("value")
    if key_col is None:
        return df.select(value)
    return df.select(F.col(key_col).cast("string").alias("key"), value)


def street_address(location: Column) -> Column:
    """``number street, city, state, country`` from a nested location."""
    street = joined(" ", location["street"]["number"].cast("string"), location["street"]["name"])
    return joined(", ", street, location["city"], location["state"], location["country"])
