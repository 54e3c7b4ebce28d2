"""Timestamps: calendar parts, age, time of day, day ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

PERIODS = {
    "hour": F.hour,
    "date": F.to_date,
    "month": F.month,
    "year": F.year,
}


def period(col: Column, unit: str) -> Column:
    """``hour`` of day, ``date``, ``month`` of year or ``year`` of a timestamp."""
    return PERIODS[unit](col)


def stamp_text(col: Column) -> Column:
    """24-hour text form of a timestamp."""
    return F.date_format(col, STAMP_FORMAT)


def from_epoch(col: Column) -> Column:
    """Epoch seconds to timestamp."""
    return F.timestamp_seconds(col)


def age_in_years(birth: Column, as_of: dt.date, floor: bool = False) -> Column:
    """Years between ``birth`` and ``as_of``, rounded (33 y 7 m gives 34).

    ``floor=True`` gives completed years.
    """
    years = F.months_between(F.lit(as_of), birth) / F.lit(12)
    return (F.floor(years) if floor else F.round(years, 0)).cast("int")


def time_of_day(hour: Column) -> Column:
    """morning 5-11, afternoon 12-17, evening 18-22, everything else night."""
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 22), "evening")
        .otherwise("night")
    )


def on_day(col: Column, day: dt.date) -> Column:
    """``DATE(col) = day`` as a half-open range, the form that sources push down."""
    start = dt.datetime.combine(day, dt.time())
    end = start + dt.timedelta(days=1)
    literal = "TIMESTAMP_NTZ '{}'".format
    return (col >= F.expr(literal(start))) & (col < F.expr(literal(end)))
