"""Shop tables: raw users, logins and order lines to a star schema and income reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.functions.dates import age_in_years, stamp_text
from siltwork.functions.money import line_total, total_differs
from siltwork.functions.people import ADDRESS_FIELDS, age_group, parse_address
from siltwork.operators import reports
from siltwork.operators.columns import lift_fields, repair_types, union_renamed
from siltwork.operators.facts import attach_headers, latest_products, order_headers
from siltwork.operators.keyed import KeyMap
from siltwork.operators.keys import dimension, lookup_key, number_rows
from siltwork.operators.partials import DAY, DayTable, Partials
from siltwork.shared import write_shared

HEADER_KEY = ("customer_email", "date", "delivery_address")


def clean_users(users: DataFrame, as_of: dt.date) -> DataFrame:
    """Typed users with age, age band and address parts."""
    typed = repair_types(users, {"id": "bigint", "dob": "timestamp"})
    aged = typed.withColumn("age", age_in_years(F.col("dob"), as_of))
    banded = aged.withColumn("age_group", age_group(F.col("age")))
    return lift_fields(banded.withColumn("_place", parse_address(F.col("address"))), "_place", ADDRESS_FIELDS)


def clean_logins(logins: DataFrame) -> DataFrame:
    return repair_types(logins, {"id": "bigint", "login_date": "timestamp", "logout_date": "timestamp"})


def clean_orders(lines: DataFrame) -> DataFrame:
    """Typed order lines with repaired totals, address parts, date and month of year."""
    typed = repair_types(
        lines,
        {
            "id": "bigint",
            "order_date": "timestamp",
            "quantity": "int",
            "unit_price": "decimal(10,2)",
            "total_price": "decimal(10,2)",
        },
    )
    quantity, price, total = F.col("quantity"), F.col("unit_price"), F.col("total_price")
    repaired = typed.withColumns(
        {
            "total_price": line_total(quantity, price),
            "was_repaired": total_differs(quantity, price, total),
            "date": F.to_date("order_date"),
            "month": F.month("order_date"),
        }
    )
    return lift_fields(
        repaired.withColumn("_place", parse_address(F.col("delivery_address"))), "_place", ADDRESS_FIELDS
    )


def address_dimension(users: DataFrame, lines: DataFrame) -> DataFrame:
    """Distinct addresses of users and deliveries, with ids in text order.

    The parts follow from the text, so only distinct texts are parsed and moved.
    """
    both = union_renamed(users.select("address"), lines.select("delivery_address"), {"delivery_address": "address"})
    parsed = both.distinct().withColumn("_place", parse_address(F.col("address")))
    return number_rows(lift_fields(parsed, "_place", ADDRESS_FIELDS), ["address"]).select(
        "id", "address", *ADDRESS_FIELDS
    )


def stable_dimension(df: DataFrame, col: str, path: str) -> DataFrame:
    """Like ``dimension``, with ids kept at ``path``: a value keeps the id it was given first."""
    return KeyMap(df.sparkSession, path, ["name"]).assign(df.select(F.col(col).alias("name"))).select("id", "name")


def stable_addresses(users: DataFrame, lines: DataFrame, path: str) -> DataFrame:
    """Like :func:`address_dimension`, with ids kept at ``path``."""
    both = union_renamed(users.select("address"), lines.select("delivery_address"), {"delivery_address": "address"})
    held = KeyMap(users.sparkSession, path, ["address"]).assign(both)
    parsed = held.withColumn("_place", parse_address(F.col("address")))
    return lift_fields(parsed, "_place", ADDRESS_FIELDS).select("id", "address", *ADDRESS_FIELDS)


def users_full(users: DataFrame, genders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Users with gender and address ids, null where the value is unknown."""
    with_gender = lookup_key(users, genders, "gender", "gender_id")
    with_both = lookup_key(with_gender, addresses, "address", "address_id", dim_key="address")
    return with_both.select(
        "id", "first_name", "last_name", "email", "address_id", "gender_id",
        stamp_text(F.col("dob")).alias("dob"), "phone_number",
    )


def logs_full(logins: DataFrame, users: DataFrame, devices: DataFrame) -> DataFrame:
    """Logins of known users on known devices."""
    with_user = lookup_key(logins, users, "user_email", "user_id", dim_key="email", how="inner")
    with_device = lookup_key(with_user, devices, "device", "device_id", how="inner")
    return with_device.select(
        "id",
        stamp_text(F.col("login_date")).alias("login_date"),
        stamp_text(F.col("logout_date")).alias("logout_date"),
        "user_id",
        "device_id",
    )


def product_full(lines: DataFrame, categories: DataFrame) -> DataFrame:
    described = lines.select(
        "id", "product_name", "product_category", F.col("product_brand").alias("brand"),
        F.col("unit_price").alias("price"), F.col("product_description").alias("description"),
    )
    return latest_products(
        described, categories, "product_name", "product_category", ("brand", "price", "description"), "id"
    )


def numbered_headers(lines: DataFrame) -> DataFrame:
    """Order headers at the grain of customer, date and delivery address."""
    return order_headers(lines, HEADER_KEY, "total_price", ("date", "customer_email"), "order_id")


def known_headers(headers: DataFrame, users: DataFrame, addresses: DataFrame) -> DataFrame:
    """Headers of known customers, with customer and delivery address ids."""
    with_user = lookup_key(headers, users, "customer_email", "customer_id", dim_key="email", how="inner")
    return lookup_key(
        with_user, addresses, "delivery_address", "delivery_address_id", dim_key="address", how="inner"
    )


def orders_full(known: DataFrame) -> DataFrame:
    return known.select(
        F.col("order_id").alias("id"),
        "customer_id",
        F.col("customer_email").alias("email"),
        F.col("date").alias("order_date"),
        F.col("order_total_price").alias("total_price"),
        "delivery_address_id",
    )


def order_items_full(lines: DataFrame, known: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with order and product ids, joined on customer, date and address.

    The join uses the headers' own key texts, so lines move once.
    """
    headed = attach_headers(lines, known, HEADER_KEY, "order_id", "order_id")
    with_product = lookup_key(headed, products, "product_name", "product_id", how="inner")
    return with_product.select("id", "order_id", "product_id", "quantity", "unit_price", "total_price")


class Silver:
    """All silver tables, each built when it is first asked for.

    Cleaned tables and headers are written before they feed several others, so the raw
    sources are read once, and only what a table needs is built for it.  With ``ids``, a folder,
    the ids of addresses, genders, categories and devices are kept there, so that rows written by earlier
    runs still point at the same values; else each run numbers them anew in value order.
    """

    def __init__(self, users: DataFrame, logins: DataFrame, lines: DataFrame, as_of: dt.date, ids: str | None = None):
        self._raw = users, logins, lines
        self._as_of, self._ids = as_of, ids

    @cached_property
    def users(self) -> DataFrame:
        return write_shared(clean_users(self._raw[0], self._as_of), "cleaned-users")

    @cached_property
    def logins(self) -> DataFrame:
        return write_shared(clean_logins(self._raw[1]), "cleaned-logs")

    @cached_property
    def lines(self) -> DataFrame:
        return write_shared(clean_orders(self._raw[2]), "cleaned-orders")

    def _dimension(self, df: DataFrame, col: str, name: str) -> DataFrame:
        return stable_dimension(df, col, f"{self._ids}/{name}") if self._ids else dimension(df, col)

    @cached_property
    def address(self) -> DataFrame:
        if self._ids:
            return stable_addresses(self.users, self.lines, f"{self._ids}/address")
        return address_dimension(self.users, self.lines)

    @cached_property
    def gender(self) -> DataFrame:
        return self._dimension(self.users, "gender", "gender")

    @cached_property
    def category(self) -> DataFrame:
        return self._dimension(self.lines, "product_category", "category")

    @cached_property
    def device(self) -> DataFrame:
        return self._dimension(self.logins, "device", "device")

    @cached_property
    def _known(self) -> DataFrame:
        return write_shared(known_headers(numbered_headers(self.lines), self.users, self.address), "headers")

    @cached_property
    def users_full(self) -> DataFrame:
        return users_full(self.users, self.gender, self.address)

    @cached_property
    def logs_full(self) -> DataFrame:
        return logs_full(self.logins, self.users, self.device)

    @cached_property
    def product_full(self) -> DataFrame:
        return product_full(self.lines, self.category)

    @cached_property
    def orders_full(self) -> DataFrame:
        return orders_full(self._known)

    @cached_property
    def order_items_full(self) -> DataFrame:
        return order_items_full(self.lines, self._known, self.product_full)


def build_silver(users: DataFrame, logins: DataFrame, lines: DataFrame, as_of: dt.date, ids: str | None = None) -> Silver:
    """The silver tables of these sources; see :class:`Silver`."""
    return Silver(users, logins, lines, as_of, ids)


def spent_by(users: DataFrame, lines: DataFrame) -> DataFrame:
    """Total of each known user, with gender and age band.

    Lines are summed by e-mail before the join, so a user with very many lines
    reaches it as one row.
    """
    people = users.select(F.col("email").alias("_email"), "gender", "age_group")
    totals = reports.total_by(lines, ["customer_email"], "total_price", "total_price")
    return totals.join(people, F.col("customer_email") == F.col("_email"))


GOLD: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "total_income_by_hours": lambda users, lines: reports.income_by_hour(lines, "order_date", "total_price"),
    "total_income_by_genders": lambda users, lines: reports.income_by_group_ranked(
        spent_by(users, lines), "gender", "total_price"
    ),
    "total_income_by_dates": lambda users, lines: reports.income_by_date(lines, "order_date", "total_price"),
    "total_income_by_dates_with_month": lambda users, lines: reports.income_by_date_with_profit(
        lines, "order_date", "total_price"
    ),
    "total_income_by_avg_month": lambda users, lines: reports.income_vs_month_average(
        lines, "order_date", "total_price"
    ),
    "profit_by_age_group_and_gender": lambda users, lines: reports.income_by_groups(
        spent_by(users, lines), ["gender", "age_group"], "total_price"
    ),
}


def build_gold(users: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """The six income reports over cleaned users and order lines that are already stored."""
    return {name: report(users, lines) for name, report in GOLD.items()}


class GoldRefresh:
    """The six income reports over order lines that arrive in batches.

    Lines are kept by month below ``base``; of each hour and customer a partial total is kept.  A batch makes the
    partials of the months it falls in anew, and the reports are made of partials alone: all of
    them add up totals.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.lines = DayTable(spark, f"{base}/lines", "order_date", unit="month")
        grain = {"hours": F.hour("order_date"), "customer_email": F.col("customer_email")}
        self.totals = Partials(spark, f"{base}/totals", grain, {"total_price": ("sum", F.col("total_price"))})

    def add(self, lines: DataFrame, batch_id: int) -> list[str]:
        """Take in a batch of cleaned lines; the months that were read."""
        self.lines.append(lines.select("order_date", "customer_email", "total_price"), batch_id)
        return self.totals.refresh(self.lines)

    def reports(self, users: DataFrame) -> dict[str, DataFrame]:
        stamp = F.make_timestamp(F.year(DAY), F.month(DAY), F.dayofmonth(DAY), F.col("hours"), F.lit(0), F.lit(0))
        return build_gold(users, self.totals.read().select(stamp.alias("order_date"), "customer_email", "total_price"))
