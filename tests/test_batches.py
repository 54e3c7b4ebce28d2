"""Ledgers by folder, even ranges, landed files, folds from one aggregate, state that moves."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from siltwork.learning.folds import best_penalty, cross_validated, fold_of, products_by_fold, ridge_fit, squared_error
from siltwork.learning.models import ridge_penalty
from siltwork.operators.ledger import Ledger
from siltwork.operators.partials import DayTable
from siltwork.plans.clicks import process_new
from siltwork.published import Published
from siltwork.sources.landing import LandedFiles, read_landed
from siltwork.sources.splits import literal, plan_splits
from siltwork.streaming.queries import run_available
from siltwork.streaming.state import carried_counts, counts_in_state, seed_counts
from siltwork.streaming.batches import published_sink


def uploads(spark, *rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d, 10), "uploaded") for i, d in rows], "id bigint, ts timestamp, status string")


def test_ledger_reads_open_folders_only(spark, tmp_path):
    source, ledger = DayTable(spark, str(tmp_path / "s"), "ts"), Ledger(spark, str(tmp_path / "l"))
    ids = lambda df: sorted(r["id"] for r in df.collect())
    source.append(uploads(spark, (1, 1), (2, 1), (3, 2)))
    assert ids(ledger.waiting(source.table)) == [1, 2, 3]
    ledger.mark(source.table, spark.createDataFrame([(1,), (1,), (None,), (99,)], "id bigint"))
    assert ids(ledger.waiting(source.table)) == [2, 3] and ledger.done() == {}
    ledger.mark(source.table, spark.createDataFrame([(2,)], "id bigint"))  # the first day has none left
    assert list(ledger.done()) == ["2024-01-01"] and ids(ledger.singles.read()) == []
    waiting = ledger.waiting(source.table)
    assert ids(waiting) == [3] and all("2024-01-02" in f for f in waiting.inputFiles() if "/s/" in f)
    ledger.finish(source.table.manifest())
    source.append(uploads(spark, (4, 1), (5, 3)))
    assert ids(ledger.waiting(source.table)) == [4, 5]
    ledger.mark(source.table, spark.createDataFrame([(5,)], "id bigint"))
    marked = {r["id"]: r["status"] for r in ledger.marked(source.table, "status", "done").collect()}
    assert marked == {1: "done", 2: "done", 3: "done", 4: "uploaded", 5: "done"}
    ledger.finish(source.table.manifest())
    assert ids(ledger.waiting(source.table)) == []


def test_ledger_keeps_ids_of_half_done_folders(spark, tmp_path):
    source, ledger = DayTable(spark, str(tmp_path / "s"), "ts"), Ledger(spark, str(tmp_path / "l"))
    source.append(uploads(spark, (1, 1), (2, 2), (3, 2), (4, 2)))
    ledger.mark(source.table, spark.createDataFrame([(1,), (2,)], "id bigint"))
    assert [r["id"] for r in ledger.singles.read().collect()] == [2]
    assert sorted(r["id"] for r in ledger.waiting(source.table).collect()) == [3, 4]


def test_clicks_are_enriched_once(spark, tmp_path):
    row = lambda i, day: (i, dt.datetime(2024, 1, day, 9), "0.0.0.9", 30, "Mozilla/5.0 (Windows NT 10.0; Laptop) Chrome/1", "u", dt.datetime(2024, 1, 9), "uploaded")
    schema = "id string, activity_time timestamp, ip_address string, age int, log string, username string, created_at timestamp, status string"
    clicks = DayTable(spark, str(tmp_path / "clicks"), "activity_time")
    target = Published(spark, str(tmp_path / "out"))
    bands = spark.createDataFrame([(0, 255, "A", "B")], "ip_from bigint, ip_to bigint, country string, city string")
    clicks.append(spark.createDataFrame([row("a", 1), row("b", 2)], schema))
    assert process_new(clicks, bands, target).count() == 2
    assert process_new(clicks, bands, target).count() == 0
    clicks.append(spark.createDataFrame([row("c", 2)], schema))
    assert [r["id"] for r in process_new(clicks, bands, target).collect()] == ["c"]
    assert sorted((r["id"], r["country"]) for r in target.read().collect()) == [("a", "A"), ("b", "A"), ("c", "A")]


@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(20,2)", "date", "timestamp"])
def test_ranges_hold_each_row_once(spark, kind):
    rng = random.Random(1)
    values = [int(rng.paretovariate(0.7)) % 20_000 for _ in range(4000)] + [500] * 3000 + [None] * 20
    number = spark.createDataFrame([(v,) for v in values], "v bigint")
    as_date = F.date_add(F.lit("2020-01-01").cast("date"), F.col("v").cast("int"))
    rows = number.select((as_date.cast(kind) if kind in ("date", "timestamp") else F.col("v").cast(kind)).alias("v"))
    plans = plan_splits(rows, "v", 12)
    parts = [rows.where(p) for p in plans]
    sizes = [(p.count(), p.distinct().count()) for p in parts]
    assert sum(n for n, _ in sizes) == len(values)
    assert max(n for n, different in sizes if different > 1) <= 2 * len(values) / 12
    assert any(n >= 3000 and different == 1 for n, different in sizes)


def test_ranges_of_little(spark):
    rows = spark.createDataFrame([(None,), (None,)], "v int")
    assert plan_splits(rows, "v", 4) == ["1 = 1"] and plan_splits(rows, "v", 1) == ["1 = 1"]
    one = spark.createDataFrame([(5,), (None,)], "v int")
    assert sum(one.where(p).count() for p in plan_splits(one, "v", 3)) == 2
    assert plan_splits(one, "v", 2, quoted='"V"')[0].startswith('("V" <')
    with pytest.raises(ValueError):
        plan_splits(spark.createDataFrame([("a",)], "v string"), "v", 2)
    assert literal("o'clock") == "'o''clock'" and literal(Decimal("1.50")) == "1.50" and literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'"


def test_landed_files_are_told_by_content(spark, tmp_path):
    land = tmp_path / "in"
    land.mkdir()
    put = lambda name, *rows: (land / name).write_text("id,v\n" + "".join(f"{r}\n" for r in rows))
    files = LandedFiles(spark, str(tmp_path / "manifest"))
    schema = spark.createDataFrame([], "id int, v string").schema

    def round_of():
        looked = files.look(f"{land}/*.csv")
        states = {r["path"].rsplit("/", 1)[1]: r["state"] for r in looked.collect()}
        rows = sorted(map(tuple, read_landed(spark, looked, schema).collect()))
        files.take(looked)
        return states, rows

    put("a.csv", "1,x", "2,y")
    put("b.csv", "3,z")
    put("twin.csv", "3,z")
    assert round_of() == ({"a.csv": "new", "b.csv": "new", "twin.csv": "copy"}, [(1, "x"), (2, "y"), (3, "z")])
    assert round_of() == ({}, [])
    put("a.csv", "9,changed rows")
    put("c.csv", "1,x", "2,y")
    put("b.csv", "3,z")
    states, rows = round_of()
    assert states.pop("b.csv", "touched") == "touched"  # a time of change may not differ
    assert (states, rows) == ({"a.csv": "changed", "c.csv": "copy"}, [(9, "changed rows")])
    assert files.known().count() == 4


def test_folds_from_products_are_folds_from_rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3)) * [1, 50, 0.1] + [5, 1000, 0]
    y = x @ [2.0, -0.3, 7.0] + rng.normal(size=300) + 4
    rows = spark.createDataFrame([(k, *map(float, a), float(b)) for k, (a, b) in enumerate(zip(x, y))] + [(999, None, 1.0, 1.0, 1.0)], "k int, a double, b double, c double, y double")
    found = cross_validated(rows, ["a", "b", "c"], "y", [0.0, 5.0], F.col("k") % 4).collect()
    assert len(found) == 8 and sum(r["rows"] for r in found) == 600
    for r in found:
        own = np.arange(300) % 4 == r["fold"]
        mean, m = x[~own].mean(0), y[~own].mean()
        c = x[~own] - mean
        slopes = np.linalg.solve(c.T @ c + r["alpha"] * np.eye(3), c.T @ (y[~own] - m))
        error = np.mean((y[own] - m - (x[own] - mean) @ slopes) ** 2)
        assert np.allclose([r["slope_a"], r["slope_b"], r["slope_c"], r["mean_squared_error"]], [*slopes, error], rtol=1e-7)
    assert cross_validated(rows.where("false"), ["a"], "y", [1.0], F.col("k")).count() == 0
    assert cross_validated(rows, ["a"], "y", [1.0], F.lit(0)).count() == 0
    assert best_penalty({10.0: 2.0, 1.0: 2.0, 5.0: 3.0}) == 1.0
    assert {r[0] for r in rows.select(fold_of(["k"])).distinct().collect()} == {0, 1, 2, 3, 4}


def test_fitted_models_agree_with_products(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(float(a), float(b), float(3 * a - b + e)) for a, b, e in rng.normal(size=(200, 3))], "a double, b double, y double")
    assembled = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    _, products = products_by_fold(rows, ["a", "b"], "y", F.lit(0))
    spread = rows.agg(F.stddev_pop("y")).first()[0]
    for alpha in (0.0, 10.0):
        model = LinearRegression(labelCol="y", regParam=ridge_penalty(alpha, spread, 200), standardization=False, solver="normal").fit(assembled)
        fitted = ridge_fit(products[0], alpha)
        assert np.allclose(model.coefficients.toArray(), fitted[1:], atol=1e-6)
        error = model.transform(assembled).agg(F.sum((F.col("y") - F.col("prediction")) ** 2)).first()[0]
        assert np.isclose(error, squared_error(products[0], fitted), rtol=1e-6)


def test_state_goes_on_with_other_partitions(spark, tmp_path):
    rows = [(None if k % 11 == 0 else k % 5, f"w{k % 3}") for k in range(200)]
    frame = spark.createDataFrame(rows, "a int, b string")
    for half, part in enumerate(frame.randomSplit([0.5, 0.5], 7)):
        part.write.parquet(str(tmp_path / f"in{half}"))
    stream = lambda half: spark.readStream.schema(frame.schema).parquet(str(tmp_path / f"in{half}"))
    first, after, seeds = str(tmp_path / "first"), str(tmp_path / "after"), str(tmp_path / "seeds")
    run_available(stream(0).groupBy("a", "b").count(), published_sink(f"{first}/out"), f"{first}/check", output_mode="complete")
    held = sorted(map(str, counts_in_state(spark, f"{first}/check", ["a", "b"]).collect()))
    assert held == sorted(map(str, Published(spark, f"{first}/out").read().collect()))
    seed_counts(spark, f"{first}/check", ["a", "b"], seeds)
    with pytest.raises(Exception, match="already exists"):
        seed_counts(spark, f"{first}/check", ["a", "b"], seeds)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for _ in range(2):  # the second run finds nothing new
            run_available(carried_counts(stream(1), ["a", "b"], seeds), published_sink(f"{after}/out"), f"{after}/check", output_mode="complete")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = frame.groupBy("a", "b").count()
    assert sorted(map(str, Published(spark, f"{after}/out").read().collect())) == sorted(map(str, expected.collect()))
