"""Customer attributes: age band and postal address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound of each age band, highest first, and the band below.
AGE_BANDS = ((60, "60+"), (41, "41-60"), (26, "26-40"), (18, "18-25"))
YOUNGEST_BAND = "1-18"
AGE_BAND_ORDER = ("1-18", "18-25", "26-40", "41-60", "60+")
TIME_OF_DAY_ORDER = ("morning", "afternoon", "evening", "night")

ADDRESS_FIELDS = ("street1", "street2", "city", "country")


def age_group(age: Column, null_label: str | None = None) -> Column:
    """Band of an age.

    With ``null_label`` a null or zero age gets that label; without it a null
    age gives null.
    """
    if null_label is None:
        banded = F.when(age.isNull(), F.lit(None).cast("string"))
    else:
        banded = F.when(age.isNull() | (age == 0), null_label)
    for lowest, label in AGE_BANDS:
        banded = banded.when(age >= lowest, label)
    return banded.otherwise(YOUNGEST_BAND)


def parse_address(address: Column) -> Column:
    """Struct of ``ADDRESS_FIELDS`` from comma text.

    Four parts fill all fields, three leave ``street2`` blank, any other count
    gives four blanks.  A null address gives four nulls.  The part count is the
    first thing every field tests, so the text is split once per row.
    """
    pieces = F.split(address, ",")
    count = F.size(pieces)

    def piece(four: int, three: int | None) -> Column:
        short = F.lit("") if three is None else F.trim(F.get(pieces, F.lit(three)))
        full = F.trim(F.get(pieces, F.lit(four)))
        return F.when(count == 4, full).when(count == 3, short).when(address.isNotNull(), "")

    places = {"street1": (0, 0), "street2": (1, None), "city": (2, 1), "country": (3, 2)}
    return F.struct(*(piece(*places[name]).alias(name) for name in ADDRESS_FIELDS))
