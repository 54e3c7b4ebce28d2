from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltwork.functions import agents, dates, messages, money, network, people, text
from siltwork.plans.clicks import decode_clicks
from siltwork.plans.tables import CLICKS
from siltwork.plans.users import decode_users, flatten_records


def values(spark, kind, inputs, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"n int, c {kind}")
    return [r[0] for r in df.orderBy("n").select(build(F.col("c"))).collect()]


def test_part_trims_and_is_null_past_the_end(spark):
    assert values(spark, "string", ["a, b", "a", None], lambda c: text.part(c, ",", 1)) == ["b", None, None]


def test_word_normalisation_and_filter(spark):
    inputs = [" The ", "42", "Straße", "\nNew", "日本", None, ""]
    assert values(spark, "string", inputs, text.normal_word) == ["the", "42", "straße", "\nnew", "日本", None, ""]
    kept = values(spark, "string", inputs, lambda c: text.is_word(text.normal_word(c)))
    assert kept == [True, False, True, True, False, False, False]


def test_prefix(spark):
    assert values(spark, "string", ["sun", "moon", "", None], lambda c: text.has_prefix(c, "s")) == [True, False, False, None]


def test_age_is_rounded_by_default(spark):
    births = [dt.datetime(1990, 11, 15), dt.datetime(1991, 6, 15), None]
    as_of = dt.date(2024, 6, 15)
    assert values(spark, "timestamp_ntz", births, lambda c: dates.age_in_years(c, as_of)) == [34, 33, None]
    assert values(spark, "timestamp_ntz", births, lambda c: dates.age_in_years(c, as_of, floor=True)) == [33, 33, None]


def test_stamp_text_uses_24_hours(spark):
    assert values(spark, "timestamp_ntz", [dt.datetime(2024, 1, 2, 15, 4, 5)], dates.stamp_text) == ["2024-01-02 15:04:05"]


def test_time_of_day_bounds(spark):
    hours = [4, 5, 11, 12, 17, 18, 22, 23, None]
    assert values(spark, "int", hours, dates.time_of_day) == [
        "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night",
    ]


def test_on_day_is_half_open(spark):
    stamps = [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 23, 59, 59, 999999), dt.datetime(2024, 1, 3), None]
    assert values(spark, "timestamp_ntz", stamps, lambda c: dates.on_day(c, dt.date(2024, 1, 2))) == [True, True, False, None]
    assert values(spark, "timestamp", stamps, lambda c: dates.on_day(c, dt.date(2024, 1, 2))) == [True, True, False, None]


@pytest.mark.parametrize(
    ("age", "plain", "labelled"),
    [(0, "1-18", "None"), (17, "1-18", "1-18"), (18, "18-25", "18-25"), (25, "18-25", "18-25"), (26, "26-40", "26-40"),
     (40, "26-40", "26-40"), (41, "41-60", "41-60"), (59, "41-60", "41-60"), (60, "60+", "60+"), (150, "60+", "60+"),
     (None, None, "None")],
)
def test_age_groups(spark, age, plain, labelled):
    assert values(spark, "int", [age], people.age_group) == [plain]
    assert values(spark, "int", [age], lambda c: people.age_group(c, "None")) == [labelled]


def test_address_parts(spark):
    inputs = ["1 A St, Flat 2, Bonn, Germany", "1 A St, Bonn, Germany", "Bonn", "1 A St,, Bonn, Germany", "a,b,c,d,e", None]
    assert [tuple(v) for v in values(spark, "string", inputs, people.parse_address)] == [
        ("1 A St", "Flat 2", "Bonn", "Germany"),
        ("1 A St", "", "Bonn", "Germany"),
        ("", "", "", ""),
        ("1 A St", "", "Bonn", "Germany"),
        ("", "", "", ""),
        (None, None, None, None),
    ]


def test_line_total(spark):
    df = spark.createDataFrame(
        [(2, Decimal("1.25"), Decimal("2.50")), (2, Decimal("1.25"), Decimal("2.40")), (None, Decimal("1.00"), Decimal("1.00"))],
        "q int, p decimal(10,2), t decimal(10,2)",
    )
    found = df.select(money.line_total(F.col("q"), F.col("p")), money.total_differs(F.col("q"), F.col("p"), F.col("t")))
    assert [tuple(r) for r in found.collect()] == [(Decimal("2.50"), False), (Decimal("2.50"), True), (None, False)]


def test_exact_average_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.01"), 2), (Decimal("1.00"), 3), (Decimal("5.00"), 0)], "t decimal(20,2), n bigint")
    assert [r[0] for r in df.select(money.exact_average(F.col("t"), F.col("n"))).collect()] == [
        Decimal("0.01"), Decimal("0.33"), None,
    ]


@pytest.mark.parametrize(
    ("agent", "expected"),
    [
        ("Mozilla/5.0 (Windows NT 10.0; Laptop) AppleWebKit/537.36 Chrome/90.0 Win64; x64 Safari/537.36", ("Laptop", "Windows", "Chrome")),
        ("Mozilla/5.0 (Linux; Android 9; Tablet) AppleWebKit/537.36 Firefox/60.0 Mobile Safari/537.36", ("Tablet", "Android", "Firefox")),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_12; Mobile) Opera/70.0  Safari/537.36", ("Mobile", "Mac OS X", "Opera")),
        ("Mozilla/5.0 (Windows NT 6.1; Mobile) Edge/80.0 Win64; x64 Safari/537.36", ("Mobile", "Windows", "Edge")),
        ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15; Laptop) Safari/60.0  Safari/537.36", ("Laptop", "Mac OS X", "Safari")),
        ("curl", ("Laptop", "Other", "Other")),
    ],
)
def test_user_agents(spark, agent, expected):
    build = lambda c: F.struct(agents.device_type(c), agents.os_family(c), agents.browser_family(c))
    assert tuple(values(spark, "string", [agent], build)[0]) == expected


def test_ipv4_numbers(spark):
    inputs = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "a.b.c.d", "1. 2.3.4", "", None]
    assert values(spark, "string", inputs, network.ipv4_number) == [
        16909060, 0, 4294967295, None, None, None, None, None, None, None,
    ]


def test_click_messages_decode_field_by_field(spark):
    good = '{"username":"u","age":30,"activity_time":"2024-01-02 15:04:05","ip_address":"1.2.3.4"}'
    blank_age = '{"username":"v","age":""}'
    bad_time = '{"username":"w","age":7,"activity_time":"soon"}'
    messages_in = [good, blank_age, bad_time, "not json", None]
    df = spark.createDataFrame([(m.encode() if m else None,) for m in messages_in], "value binary")
    found = [(r.username, r.age, r.activity_time) for r in decode_clicks(df).collect()]
    assert found == [("u", 30, dt.datetime(2024, 1, 2, 15, 4, 5)), ("v", None, None), ("w", 7, None), (None, None, None),
                     (None, None, None)]
    kept = decode_clicks(df, keep_corrupt=True).where(F.col(messages.CORRUPT).isNotNull())
    assert {r[messages.CORRUPT] for r in kept.collect()} == {blank_age, bad_time, "not json"}


def test_nested_user_flatten_skips_nulls_and_gets_an_id(spark):
    record = (
        '{"name":{"first":"Ada","last":"L"},"gender":"female","location":{"street":{"number":7,"name":"High St"},'
        '"city":"Bath","country":"UK","postcode":"BA1"},"email":"a@x","login":{"username":"ada"},'
        '"dob":{"date":"1990"},"registered":{"date":"2020"},"phone":"1","picture":{"medium":"p"}}'
    )
    flat = flatten_records(spark.createDataFrame([(record.encode(),)], "value binary"))
    row = flat.collect()[0]
    assert (row.first_name, row.address, row.post_code, row.dob) == ("Ada", "7 High St, Bath, UK", "BA1", "1990")
    users = decode_users(messages.encode_rows(flat)).collect()
    assert users[0].username == "ada" and len(users[0].id) == 36
    assert decode_users(messages.encode_rows(flat)).collect()[0].id == users[0].id


def test_encode_rows_keeps_key_and_value(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert [tuple(r) for r in messages.encode_rows(df, "id").collect()] == [("1", '{"id":1,"name":"a"}')]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([("u", None)], "username string, status string")
    filled = CLICKS.fill_absent(df)
    row = filled.collect()[0]
    assert row.status is None and len(row.id) == 36 and row.created_at is not None
