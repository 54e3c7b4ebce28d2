"""Totals, counts, ranks and period comparisons.

Windows without a partition key are used here only over calendar periods, whose
number is bounded by the calendar and not by the data: 24 hours, 12 months a
year, at most 3.7 million dates in all.  Ranks over free-form groups go through
:func:`siltwork.operators.keys.rank_rows`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.functions.dates import period
from siltwork.functions.money import exact_average, share_percent
from siltwork.operators.columns import order_by_list
from siltwork.operators.keys import rank_rows


def total_by(df: DataFrame, by: Sequence[str], value: str, as_col: str = "total_income") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(as_col))


def count_by(df: DataFrame, by: Sequence[str], counted: str | None = None, as_col: str = "amount") -> DataFrame:
    """Non-null count of ``counted``, the first key by default: a null group counts 0."""
    return df.groupBy(*by).agg(F.count(counted or by[0]).alias(as_col))


def income_by_period(df: DataFrame, stamp: str, value: str, unit: str, as_col: str) -> DataFrame:
    """Total per period of a timestamp."""
    return df.groupBy(period(F.col(stamp), unit).alias(as_col)).agg(F.sum(value).alias("total_income"))


def income_by_hour(df: DataFrame, stamp: str, value: str) -> DataFrame:
    return income_by_period(df, stamp, value, "hour", "hours").orderBy(F.desc("total_income"))


def income_by_date(df: DataFrame, stamp: str, value: str) -> DataFrame:
    return income_by_period(df, stamp, value, "date", "date").orderBy("date")


def income_by_group_ranked(df: DataFrame, group: str, value: str, ascending: bool = True) -> DataFrame:
    """Total per group; by default the lowest total has rank 1."""
    return rank_rows(total_by(df, [group], value), "total_income", ascending)


def income_by_month_and_date(df: DataFrame, stamp: str, value: str) -> DataFrame:
    """Total per date with its month of year."""
    day = F.to_date(stamp)
    return df.groupBy(day.alias("date")).agg(F.sum(value).alias("total_income")).select(
        F.month("date").alias("month"), "date", "total_income"
    )


def with_previous(df: DataFrame, value: str, order_by: Sequence[str], previous: str, change: str) -> DataFrame:
    """Value of the period before, 0 for the first, and the difference."""
    before = F.lag(value, 1, 0).over(Window.orderBy(*order_by))
    return df.withColumn(previous, before).withColumn(change, F.col(value) - F.col(previous))


def income_by_date_with_profit(df: DataFrame, stamp: str, value: str) -> DataFrame:
    dates = income_by_month_and_date(df, stamp, value)
    return with_previous(dates, "total_income", ["month", "date"], "prev_income", "profit").orderBy("month", "date")


def income_vs_month_average(df: DataFrame, stamp: str, value: str, per_month: bool = False) -> DataFrame:
    """Each date against the average of the dates up to and including its month of year.

    ``per_month`` averages each month of each year on its own.
    """
    dates = income_by_month_and_date(df, stamp, value)
    frame = Window.partitionBy(F.year("date"), "month") if per_month else Window.orderBy("month")
    average = exact_average(F.sum("total_income").over(frame), F.count("total_income").over(frame))
    return (
        dates.withColumn("avg_month", average)
        .withColumn("income_more_than_month_avg", F.col("total_income") >= F.col("avg_month"))
        .orderBy("date")
    )


def income_by_groups(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    return total_by(df, groups, value).orderBy(*groups)


def clicks_ranked(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of a column, most frequent first."""
    return rank_rows(count_by(df, [col]), "amount").orderBy("rank")


def clicks_by_lists(df: DataFrame, first: tuple[str, Sequence[str]], second: tuple[str, Sequence[str]]) -> DataFrame:
    """Rows per pair of values, sorted by two explicit value orders."""
    (one, one_order), (two, two_order) = first, second
    counted = count_by(df, [one, two])
    return counted.orderBy(order_by_list(F.col(one), one_order), order_by_list(F.col(two), two_order))


def grew(change: Column) -> Column:
    return F.coalesce(change > 0, F.lit(False))


def clicks_by_month(df: DataFrame, stamp: str, per_year: bool = False) -> DataFrame:
    """Rows per year and month with growth and share of the running total.

    ``year_sum`` runs over all years so far; ``per_year`` restarts it each year.
    """
    col = F.col(stamp)
    months = df.groupBy(F.year(col).alias("years"), F.month(col).alias("month")).agg(
        F.count(F.year(col)).alias("current_period_amount")
    )
    frame = Window.partitionBy("years") if per_year else Window.orderBy("years")
    return (
        with_previous(months, "current_period_amount", ["years", "month"], "previous_period_amount", "increase")
        .withColumn("clicks_increase", grew(F.col("increase")))
        .withColumn("year_sum", F.sum("current_period_amount").over(frame))
        .withColumn("percentage_per_year", share_percent(F.col("current_period_amount"), F.col("year_sum")))
        .orderBy("years", "month")
    )


def average_by(df: DataFrame, by: Sequence[str], value: str, as_col: str) -> DataFrame:
    """Decimal average per group, two places, half up."""
    average = exact_average(F.sum(value), F.count(value)).cast("decimal(16,2)")
    return df.groupBy(*by).agg(average.alias(as_col))


def total_where(df: DataFrame, condition: Column, value: str, as_col: str = "total") -> DataFrame:
    """One row: the sum over the rows that match, null when none does."""
    return df.where(condition).agg(F.sum(value).alias(as_col))
