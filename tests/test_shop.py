"""The shop build on literal tables, and its invariants."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from siltwork.plans import shop

AS_OF = dt.date(2024, 6, 15)
USERS = [
    ("1", "Ada", "L", "ada@x", "Female", "1990-11-15 00:00:00", "1", "1 A St, Flat 2, Bonn, Germany"),
    ("2", "Bob", "M", "bob@x", "Male", "2000-06-15 00:00:00", None, "2 B St, Bonn, Germany"),
    ("3", "Cy", "N", "cy@x", None, "2020-01-01 00:00:00", None, "nowhere"),
]
LOGINS = [
    ("1", "2024-01-01 15:00:00", "2024-01-01 16:00:00", "ada@x", "Mobile"),
    ("2", "2024-01-01 03:00:00", "2024-01-01 04:00:00", "ghost@x", "Tablet"),
]
LINES = [
    ("1", "ada@x", "2024-01-01 15:00:00", "9 D St, , Bonn, Germany", "pen", "office", "old", "d", "2", "1.50", "3.00"),
    ("2", "ada@x", "2024-01-01 16:00:00", "8 E St, , Bonn, Germany", "pen", "office", "new", "d", "1", "2.00", "9.99"),
    ("3", "bob@x", "2024-02-01 15:30:00", "2 B St, Bonn, Germany", "cup", "home", "b", "d", "4", "5.00", "20.00"),
    ("4", "ghost@x", "2024-02-01 15:30:00", "2 B St, Bonn, Germany", "cup", "home", "b", "d", "1", "5.00", "5.00"),
]


@pytest.fixture(scope="module")
def silver(spark):
    def text(rows, names):
        return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))

    return shop.build_silver(
        text(USERS, "id first_name last_name email gender dob phone_number address"),
        text(LOGINS, "id login_date logout_date user_email device"),
        text(LINES, "id customer_email order_date delivery_address product_name product_category product_brand "
                    "product_description quantity unit_price total_price"),
        AS_OF,
    )


def test_cleaned_tables(silver):
    users = {r.id: r for r in silver.users.collect()}
    assert (users[1].age, users[1].age_group, users[1].street2) == (34, "26-40", "Flat 2")
    assert (users[3].age, users[3].city) == (4, "")
    lines = {r.id: r for r in silver.lines.collect()}
    assert lines[2].total_price == Decimal("2.00") and lines[2].was_repaired and not lines[1].was_repaired
    assert (lines[3].month, lines[3].date) == (2, dt.date(2024, 2, 1))


def test_addresses_are_shared_by_users_and_deliveries(silver):
    found = {r.address: r.id for r in silver.address.collect()}
    assert len(found) == 5 and sorted(found.values()) == [1, 2, 3, 4, 5]
    assert [found[a] for a in sorted(found)] == [1, 2, 3, 4, 5]


def test_users_keep_rows_without_a_gender(silver):
    found = {r.id: r for r in silver.users_full.collect()}
    assert len(found) == 3 and found[3].gender_id is None and found[3].address_id is not None
    assert found[1].dob == "1990-11-15 00:00:00"


def test_logins_of_unknown_users_are_dropped_and_hours_are_24(silver):
    assert [(r.id, r.login_date, r.user_id) for r in silver.logs_full.collect()] == [(1, "2024-01-01 15:00:00", 1)]


def test_products_come_from_their_latest_line(silver):
    found = {r.name: r for r in silver.product_full.collect()}
    assert (found["pen"].brand, found["pen"].price, found["pen"].id) == ("new", Decimal("2.00"), 2)


def test_two_addresses_on_a_day_are_two_orders_and_items_do_not_multiply(silver):
    orders = {r.id: r for r in silver.orders_full.collect()}
    addresses = {r.id: r.address for r in silver.address.collect()}
    assert sorted(orders) == [1, 2, 3]
    assert {addresses[o.delivery_address_id] for o in orders.values() if o.customer_id == 1} == {
        "9 D St, , Bonn, Germany", "8 E St, , Bonn, Germany"}
    items = silver.order_items_full.collect()
    assert sorted(i.id for i in items) == [1, 2, 3]
    for order in orders.values():
        assert order.total_price == sum(i.total_price for i in items if i.order_id == order.id)


def test_gold(silver):
    gold = {name: frame.collect() for name, frame in shop.build_gold(silver.users, silver.lines).items()}
    assert [(r.hours, r.total_income) for r in gold["total_income_by_hours"]] == [(15, Decimal("28.00")), (16, Decimal("2.00"))]
    assert {(r.gender, r.total_income, r["rank"]) for r in gold["total_income_by_genders"]} == {
        ("Female", Decimal("5.00"), 1), ("Male", Decimal("20.00"), 2)}
    assert [(r.date.month, r.profit) for r in gold["total_income_by_dates_with_month"]] == [
        (1, Decimal("5.00")), (2, Decimal("20.00"))]
    assert [(r.gender, r.age_group) for r in gold["profit_by_age_group_and_gender"]] == [("Female", "26-40"), ("Male", "18-25")]
    assert len(gold) == 6


def test_ids_of_earlier_runs_stay(spark, tmp_path):
    def text(rows, names):
        return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))

    users = "id first_name last_name email gender dob phone_number address"
    logins = "id login_date logout_date user_email device"
    lines = "id customer_email order_date delivery_address product_name product_category product_brand product_description quantity unit_price total_price"
    build = lambda u, l: shop.build_silver(text(u, users), text(LOGINS, logins), text(l, lines), AS_OF, str(tmp_path / "ids"))
    first = build(USERS[:2], LINES[2:])
    tables = {name: {r[1]: r[0] for r in getattr(first, name).collect()} for name in ("address", "gender", "category", "device")}
    facts = {r.id: r.address_id for r in first.users_full.collect()}
    second = build(USERS, LINES)
    for name, before in tables.items():
        after = {r[1]: r[0] for r in getattr(second, name).collect()}
        assert {k: after[k] for k in before} == before and sorted(after.values()) == list(range(1, len(after) + 1))
    assert len(tables["address"]) < second.address.count()
    assert {k: v for k, v in ((r.id, r.address_id) for r in second.users_full.collect()) if k in facts} == facts


def test_gold_of_batches_is_gold_of_all(spark, silver, tmp_path):
    refresh = shop.GoldRefresh(spark, str(tmp_path / "gold"))
    assert len(refresh.add(silver.lines.where("id <> 2"), 0)) == 2
    assert refresh.add(silver.lines.where("id <> 2"), 0) == []
    assert refresh.add(silver.lines.where("id = 2"), 1) == ["2024-01-01"]
    whole, batches = shop.build_gold(silver.users, silver.lines), refresh.reports(silver.users)
    for name in whole:
        plain = lambda df: sorted([tuple(map(str, r)) for r in df.collect()])
        assert plain(batches[name]) == plain(whole[name]), name
