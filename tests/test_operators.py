from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltwork.operators import columns, contracts, facts, geo, keys, merge, reports
from siltwork.operators.contracts import Check, Contract, Field
from siltwork.plans.tables import CHARGES, ORDER_LINES, TRAINING


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- keys -----------------------------------------------------------------


def test_number_rows_equals_a_whole_table_row_number(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.col("id").alias("v"))
    numbered = keys.number_rows(df, ["k"], "n")
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("k")))
    assert numbered.exceptAll(expected).isEmpty() and numbered.count() == 20_000


def test_number_rows_descending_with_nulls(spark, rows):
    df = frame(spark, "k int", (3,), (None,), (5,))
    assert rows(keys.number_rows(df, [F.desc("k")])) == [(3, 2), (5, 1), (None, 3)]


def test_number_rows_of_an_empty_table(spark):
    assert keys.number_rows(frame(spark, "k int"), ["k"]).collect() == []


def test_a_frequent_value_spreads_over_ranges(spark):
    """A third of the rows share the leading key; the tiebreak lets them part."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    placed = keys.place_in_order(df.repartition(8), ["k", "id"])
    sizes = [r[0] for r in placed.groupBy(keys.SLICE).count().select("count").collect()]
    assert len(sizes) == 1 or max(sizes) < 40_000  # adaptive execution may merge small ranges into one
    assert sorted(r.n for r in keys.number_rows(df, ["k", "id"], "n").collect()) == list(range(1, 60_001))


def test_identical_rows_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_BLOCK", 10)
    df = spark.range(1_000).select((F.col("id") % 3).alias("k")).union(spark.range(5).select(F.lit(99)))
    numbered = keys.number_all_rows(df, ["k"])
    expected = df.withColumn("id", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, expected.collect()))


def test_no_raw_row_goes_to_a_single_task(spark):
    """The only single-partition exchange is over partition counts."""
    df = spark.range(1000).withColumn("k", F.rand(1))
    plan = keys.number_rows(df, ["k", "id"], "n")._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate" in window and "max(_place" in window
    assert plan.count("Window [") == 1


def test_best_per_key_takes_the_last_and_breaks_ties(spark, rows):
    df = frame(spark, "name string, id int, brand string", ("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "q"), (None, 4, "n"))
    assert rows(keys.best_per_key(df, ["name"], ["id"])) == [("a", 2, "z"), ("b", None, "q"), (None, 4, "n")]
    assert rows(keys.best_per_key(df, ["name"], ["id"], latest=False)) == [("a", 1, "x"), ("b", None, "q"), (None, 4, "n")]


def test_best_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = keys.best_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_dimension_keeps_null_as_a_value(spark, rows):
    df = frame(spark, "g string", ("b",), ("a",), ("b",), (None,))
    assert rows(keys.dimension(df, "g")) == [(1, None), (2, "a"), (3, "b")]


def test_lookup_of_a_null_key_is_null(spark, rows):
    dim = frame(spark, "id int, name string", (1, "a"), (2, None))
    df = frame(spark, "g string", ("a",), (None,), ("z",))
    assert rows(keys.lookup_key(df, dim, "g", "gid")) == [("a", 1), ("z", None), (None, None)]


def test_rank_ties_and_gaps(spark, rows):
    df = frame(spark, "g string, amount int", ("a", 5), ("b", 5), ("c", 9), ("d", 1), ("e", None))
    assert rows(keys.rank_rows(df, "amount")) == [("a", 5, 2), ("b", 5, 2), ("c", 9, 1), ("d", 1, 4), ("e", None, 5)]
    assert rows(keys.rank_rows(df, "amount", ascending=True)) == [("a", 5, 3), ("b", 5, 3), ("c", 9, 5), ("d", 1, 2), ("e", None, 1)]


# --- geo ------------------------------------------------------------------


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("prefix_bits", [8, 16, 24])
def test_locate_hits_gaps_and_bad_addresses(spark, rows, broadcast, prefix_bits):
    bands = frame(
        spark, "ip_from bigint, ip_to bigint, country string, city string, region string",
        (16909060, 16909070, "A", "a", "r"), (16909071, 17000000, "B", "b", "r"), (4294967290, 4294967295, "C", "c", "r"),
    )
    df = frame(spark, "ip_address string", ("1.2.3.4",), ("1.2.3.15",), ("1.3.0.0",), ("0.0.0.0",), ("255.255.255.255",), ("x",), (None,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = rows(geo.locate(df, bands, prefix_bits=prefix_bits), "ip_address", "country")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert found == [("0.0.0.0", "Unknown"), ("1.2.3.15", "B"), ("1.2.3.4", "A"), ("1.3.0.0", "B"),
                     ("255.255.255.255", "C"), ("x", "Unknown"), (None, "Unknown")]


def test_locate_is_an_equi_join(spark):
    bands = frame(spark, "ip_from bigint, ip_to bigint, country string", (1, 2, "A"))
    df = frame(spark, "ip_address string", ("1.2.3.4",))
    plan = geo.locate(df, bands, fields=("country",))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- columns --------------------------------------------------------------


def test_order_by_list_puts_unknown_last(spark):
    df = frame(spark, "c string", ("z",), ("b",), (None,), ("a",))
    ordered = [r.c for r in df.orderBy(columns.order_by_list(F.col("c"), ["b", "a"]), F.col("c").desc_nulls_last()).collect()]
    assert ordered == ["b", "a", "z", None]


def test_shape_ignores_unknown_drops(spark):
    df = frame(spark, "a int, b int, c int", (1, 2, 3))
    assert columns.shape(df, {"c": "first"}, drop=("b", "nothing"), order=("first",)).columns == ["first", "a"]


def test_repair_types_gives_null_for_bad_text(spark, rows):
    df = frame(spark, "a string", ("1",), ("x",), (None,))
    assert rows(columns.repair_types(df, {"a": "int"})) == [(1,), (None,), (None,)]


def test_union_keeps_duplicates_by_name(spark, rows):
    one, two = frame(spark, "a int, b int", (1, 2)), frame(spark, "b int, z int", (2, 1))
    assert rows(columns.union_renamed(one, two, {"z": "a"})) == [(1, 2), (1, 2)]


# --- facts ----------------------------------------------------------------


def test_headers_split_by_address_and_items_do_not_multiply(spark, rows):
    lines = frame(
        spark, "email string, date string, address string, total decimal(10,2)",
        ("u", "d1", "x", Decimal("1.00")), ("u", "d1", "x", Decimal("2.00")), ("u", "d1", "y", Decimal("4.00")),
        (None, "d1", "x", Decimal("8.00")),
    )
    headers = facts.order_headers(lines, ["email", "date", "address"], "total", ["date", "email"], "order_id")
    assert rows(headers, "email", "address", "order_items_amount", "order_total_price", "order_id") == [
        ("u", "x", 2, Decimal("3.00"), 2), ("u", "y", 1, Decimal("4.00"), 3), (None, "x", 0, Decimal("8.00"), 1)]
    joined = facts.attach_headers(lines, headers, ["email", "date", "address"], "order_id", "oid")
    assert joined.count() == 3


def test_orphans(spark, rows):
    child, parent = frame(spark, "k string", ("a",), ("b",), (None,)), frame(spark, "p string", ("a",), ("a",))
    assert rows(facts.orphans(child, parent, "k", "p")) == [("b",)]


# --- reports --------------------------------------------------------------


def test_period_over_period_and_cumulative_year_sum(spark, rows):
    stamps = [dt.datetime(2023, 1, 1)] * 10 + [dt.datetime(2023, 2, 1)] * 20 + [dt.datetime(2024, 1, 1)] * 30 + [dt.datetime(2024, 2, 1)] * 40
    df = frame(spark, "t timestamp_ntz", *[(s,) for s in stamps])
    found = reports.clicks_by_month(df, "t").select(
        "current_period_amount", "previous_period_amount", "increase", "clicks_increase", "year_sum", "percentage_per_year"
    )
    assert [tuple(r) for r in found.collect()] == [
        (10, 0, 10, True, 30, 33.33), (20, 10, 10, True, 30, 66.67), (30, 20, 10, True, 100, 30.0), (40, 30, 10, True, 100, 40.0)]
    own = reports.clicks_by_month(df, "t", per_year=True).select("year_sum").collect()
    assert [r[0] for r in own] == [30, 30, 70, 70]


def test_income_vs_month_average_is_true_on_equality(spark):
    df = frame(spark, "t timestamp_ntz, v decimal(10,2)", (dt.datetime(2024, 1, 1), Decimal("10.00")), (dt.datetime(2024, 1, 2), Decimal("10.00")),
               (dt.datetime(2024, 2, 1), Decimal("4.00")))
    found = reports.income_vs_month_average(df, "t", "v").collect()
    assert [(r.avg_month, r.income_more_than_month_avg) for r in found] == [
        (Decimal("10.00"), True), (Decimal("10.00"), True), (Decimal("8.00"), False)]


def test_profit_starts_from_zero(spark):
    df = frame(spark, "t timestamp_ntz, v decimal(10,2)", (dt.datetime(2024, 2, 1), Decimal("3.00")), (dt.datetime(2024, 1, 5), Decimal("10.00")))
    found = [(r.prev_income, r.profit) for r in reports.income_by_date_with_profit(df, "t", "v").collect()]
    assert found == [(Decimal("0.00"), Decimal("10.00")), (Decimal("10.00"), Decimal("-7.00"))]


def test_sorted_reports_come_sorted(spark):
    df = frame(spark, "a string, b string", ("60+", "night"), ("1-18", "night"), ("1-18", "morning"), ("None", "evening"))
    found = reports.clicks_by_lists(df, ("a", ["1-18", "60+"]), ("b", ["morning", "night"])).collect()
    assert [(r.a, r.b) for r in found] == [("1-18", "morning"), ("1-18", "night"), ("60+", "night"), ("None", "evening")]
    stamps = frame(spark, "t timestamp_ntz, v int", (dt.datetime(2024, 1, 1, 3), 1), (dt.datetime(2024, 1, 1, 4), 5))
    assert [r.hours for r in reports.income_by_hour(stamps, "t", "v").collect()] == [4, 3]


def test_total_of_nothing_is_null(spark):
    assert reports.total_where(frame(spark, "v int"), F.lit(True), "v").collect()[0][0] is None


def test_average_ignores_nulls_and_rounds_half_up(spark, rows):
    df = frame(spark, "k string, v int", ("a", 1), ("a", 2), ("a", None), ("b", None), ("c", 200), ("c", 1), ("c", 0))
    assert rows(reports.average_by(df, ["k"], "v", "m")) == [("a", Decimal("1.50")), ("b", None), ("c", Decimal("67.00"))]


# --- merge ----------------------------------------------------------------


def test_upsert_replaces_adds_and_keeps(spark, rows):
    target = frame(spark, "k int, v string", (1, "old"), (2, "old"), (None, "old"))
    source = frame(spark, "k int, v string", (2, "a"), (2, "b"), (3, "new"), (None, "n1"), (None, "n1"))
    assert rows(merge.upsert(target, source, ["k"])) == [
        (1, "old"), (2, "b"), (3, "new"), (None, "n1"), (None, "n1"), (None, "old")]


def test_upsert_can_refuse_repeated_keys(spark):
    target, source = frame(spark, "k int, v string", (1, "x")), frame(spark, "k int, v string", (2, "a"), (2, "b"))
    with pytest.raises(PySparkException, match="key repeated"):
        merge.upsert(target, source, ["k"], on_duplicate="fail").collect()
    once = frame(spark, "k int, v string", (2, "a"))
    assert merge.upsert(target, once, ["k"], on_duplicate="fail").count() == 2


def test_insert_ignore_keeps_the_first_arrival(spark, rows):
    target = frame(spark, "k int, n int, v string", (1, 0, "old"))
    source = frame(spark, "k int, n int, v string", (1, 1, "late"), (2, 3, "second"), (2, 2, "first"))
    assert rows(merge.insert_ignore(target, source, ["k"], ["n"])) == [(1, 0, "old"), (2, 2, "first")]


def test_processed_rows_are_marked_and_left_out(spark, rows):
    logs = frame(spark, "id int, status string", (1, "uploaded"), (2, "uploaded"))
    ledger = frame(spark, "id int", (2,), (2,), (9,))
    assert rows(merge.mark_processed(logs, ledger, "id")) == [(1, "uploaded"), (2, "transformed")]
    assert rows(merge.unprocessed(logs, ledger, "id")) == [(1, "uploaded")]


def test_publish_replaces_a_table_that_feeds_itself(spark, rows):
    merge.publish(frame(spark, "k int", (1,)), "published")
    merge.publish(spark.table("published").union(frame(spark, "k int", (2,))), "published")
    assert rows(spark.table("published")) == [(1,), (2,)]


# --- contracts ------------------------------------------------------------

LINE = dict(
    id=1, customer_email="a@x", order_date="2024-01-02 03:04:05", delivery_address="x", product_name="p", product_category="c",
    product_brand="b", product_description="d", quantity="1", unit_price="2.00", total_price="2.00",
)


def lines(spark, *changes):
    schema = ", ".join(f"{name} string" for name in LINE)
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in {**LINE, **c}.values()) for c in changes], schema)


@pytest.mark.parametrize(
    ("change", "broken"),
    [
        ({}, []),
        ({"quantity": 0}, ["quantity:check"]),
        ({"quantity": None}, ["quantity:not_null"]),
        ({"quantity": "many"}, ["quantity:type"]),
        ({"unit_price": "-1.00"}, ["unit_price:check"]),
        ({"total_price": "123456789.00"}, ["total_price:type"]),
        ({"product_name": "x" * 256}, ["product_name:length"]),
        ({"customer_email": None}, []),
        ({"order_date": "soon", "delivery_address": None}, ["order_date:type", "delivery_address:not_null"]),
    ],
)
def test_violations(spark, change, broken):
    assert ORDER_LINES.with_violations(lines(spark, change)).collect()[0].violations == broken


def test_split_keeps_every_row_once_and_types_the_good(spark):
    df = lines(spark, {}, {"quantity": 0}, {"id": 2})
    good, bad = ORDER_LINES.split(df)
    assert good.count() + bad.count() == 3
    assert dict(good.dtypes)["unit_price"] == "decimal(10,2)"
    assert [r.violations for r in bad.collect()] == [["quantity:check"]]


def test_enforce_fails_the_job(spark):
    assert ORDER_LINES.enforce(lines(spark, {})).count() == 1
    with pytest.raises(PySparkException, match="quantity:check"):
        ORDER_LINES.enforce(lines(spark, {}, {"quantity": 0})).collect()


def test_uuid_and_short_text_rules(spark):
    rules = Contract(fields=(Field("id", contracts.UUID, required=True), Field("currency", max_length=3)),
                     checks=(Check("currency", lambda c: c("currency") != "xxx"),), unique=("id",))
    df = frame(spark, "id string, currency string", ("00000000-0000-4000-8000-000000000001", "usd"), ("17", "euro"), (None, "xxx"))
    assert [r.violations for r in rules.with_violations(df).collect()] == [
        [], ["id:type", "currency:length"], ["id:not_null", "currency:check"]]


def test_duplicate_keys_leave_nulls_out(spark, rows):
    df = frame(spark, "customer_id string", ("a",), ("a",), ("b",), (None,), (None,))
    assert rows(TRAINING.duplicate_keys(df)) == [("a", 2)]


def test_charge_contract_has_its_19_columns():
    assert len(CHARGES.schema()) == 19
