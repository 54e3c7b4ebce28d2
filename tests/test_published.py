"""Versions, writers lost at each step, keyed tables, stable ids, keys over batches, partial reports, nested bands."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siltwork.operators.geo import flatten_bands
from siltwork.operators.keyed import KeyedTable, KeyIndex, KeyMap
from siltwork.operators.partials import DAY, DayTable, Partials
from siltwork.published import Conflict, Published, publish
from siltwork.streaming.batches import published_sink


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(df):
    return {f.split("/data/")[1].split("/")[0] for f in df.inputFiles()}


class Lost(Exception):
    pass


def failing(monkeypatch, owner, name, after=False):
    """Make one call fail, before or after it has done its work."""
    own = getattr(owner, name)

    def call(*args, **kwargs):
        if after:
            own(*args, **kwargs)
        raise Lost(name)

    monkeypatch.setattr(owner, name, call)


STEPS = [("stage", False), ("stage", True), ("commit", False)]
FILE_STEPS = [("write", False), ("write", True), ("rename_new", False), ("rename_new", True)]


@pytest.mark.parametrize("change", ["replace", "append"])
@pytest.mark.parametrize("owner, step, after", [("table", *s) for s in STEPS] + [("files", *s) for s in FILE_STEPS])
def test_a_lost_writer_leaves_a_whole_version(spark, tmp_path, monkeypatch, rows, owner, step, after, change):
    table = Published(spark, str(tmp_path / "t"))
    table.replace(spark.range(5))
    writer = Published(spark, str(tmp_path / "t"))
    with monkeypatch.context() as patch:
        failing(patch, writer if owner == "table" else writer.files, step, after)
        with pytest.raises(Lost):
            getattr(writer, change)(spark.range(100, 103))
    committed = step == "rename_new" and after
    expected = [(k,) for k in ([] if committed and change == "replace" else range(5))] + [(k,) for k in (range(100, 103) if committed else [])]
    assert rows(table.read()) == sorted(expected, key=str)
    getattr(table, change)(spark.range(7, 8))  # the next writer is not in the way of what was left
    assert (7,) in rows(table.read())
    table.expire(keep=1, grace_seconds=0)
    assert (7,) in rows(table.read()) and len(table.versions()) == 1


def test_two_writers_and_old_versions(spark, tmp_path, rows):
    table = Published(spark, str(tmp_path / "t"))
    assert table.manifest() is None
    with pytest.raises(ValueError):
        table.read()
    first = table.replace(spark.range(3))
    parts, counts = table.stage(spark.range(3, 4))
    table.append(spark.range(9, 10))
    with pytest.raises(Conflict):
        table.commit(first, first.schema, parts, counts)
    assert rows(table.read()) == [(0,), (1,), (2,), (9,)]
    assert rows(table.read(version=1)) == [(0,), (1,), (2,)]
    table.replace(table.read().where("id < 2"))  # reads the version it replaces
    assert rows(table.read()) == [(0,), (1,)]
    table.replace(spark.range(0))
    assert table.read().count() == 0 and table.read().columns == ["id"]
    assert table.expire(keep=2, grace_seconds=3600) == 0
    assert table.expire(keep=2, grace_seconds=-10) == 3  # two appended folders and the staged one
    assert rows(table.read(version=3)) == [(0,), (1,)]


def test_publish_in_the_catalog_keeps_the_name(spark, tmp_path, monkeypatch, rows):
    base = str(tmp_path / "versions")
    publish(spark.range(2), "kept_name", base)
    publish(spark.table("kept_name").union(spark.range(5, 6)), "kept_name", base)
    assert rows(spark.table("kept_name")) == [(0,), (1,), (5,)]
    with monkeypatch.context() as patch:
        failing(patch, spark.catalog.__class__, "refreshTable")
        patch.setattr(Published, "commit", lambda *a, **b: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            publish(spark.range(1), "kept_name", base)
    assert rows(spark.table("kept_name")) == [(0,), (1,), (5,)]
    with pytest.raises(ValueError):
        publish(spark.range(1).selectExpr("id AS other"), "kept_name", base)
    publish(spark.range(0), "kept_name", base)
    assert rows(spark.table("kept_name")) == []


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch, rows):
    path = str(tmp_path / "t")
    sink = published_sink(path, append=True)
    sink(spark.range(3), 0)
    with monkeypatch.context() as patch:
        failing(patch, Published, "commit")
        with pytest.raises(Lost):
            sink(spark.range(3, 5), 1)
    sink(spark.range(3, 5), 1)
    sink(spark.range(3, 5), 1)
    sink(spark.range(3), 0)
    assert rows(Published(spark, path).read()) == [(k,) for k in range(5)]


def keyed(spark, path, **options):
    return KeyedTable(spark, str(path), ["k"], **options)


def test_upsert_leaves_other_buckets_alone(spark, tmp_path, rows):
    table = keyed(spark, tmp_path / "t", buckets=16)
    base = spark.range(1000).selectExpr("id AS k", "'old' AS v")
    assert len(table.upsert(base)) == 16
    before = table.table.manifest()
    source = spark.createDataFrame([(7, "a"), (7, "b"), (2000, "new"), (None, "n")], "k int, v string")
    touched = table.upsert(source, ["v"])
    after = table.table.manifest()
    assert 1 <= len(touched) <= 3
    assert all(after.parts[b] == before.parts[b] for b in before.parts if b not in touched)
    assert all(after.parts[b] != before.parts[b] for b in touched)
    expected = {(k, "old") for k in range(1000) if k != 7} | {(7, "b"), (2000, "new"), (None, "n")}
    assert set(map(tuple, table.read().collect())) == expected and table.read().count() == len(expected)
    assert sum(after.rows.values()) == len(expected)
    with pytest.raises(Exception, match="key repeated in source"):
        table.upsert(source, on_duplicate="fail")
    assert table.upsert(source.where("false")) == []
    assert table.read().count() == len(expected)


def test_untouched_buckets_are_in_no_plan(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", buckets=16)
    table.upsert(spark.range(1000).selectExpr("id AS k", "'old' AS v"))
    held = table.table.manifest()
    source = spark.createDataFrame([(7, "x")], "k bigint, v string")
    touched = table.touched(held, source)
    read = table.table.read_parts(held, touched)
    assert len(touched) == 1 and len(read.inputFiles()) < len(table.read().inputFiles())
    assert "Exchange" not in plan_of(read) and all(f"__sw_part={touched[0]}/" in f for f in read.inputFiles())


def test_buckets_grow_and_folders_are_merged(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", buckets=1, rows_per_bucket=100, folders_per_bucket=2)
    for batch in range(6):
        fresh = table.insert_ignore(spark.range(batch * 50, batch * 50 + 60).selectExpr("id AS k", f"{batch} AS v"))
        assert fresh.count() == (60 if batch == 0 else 50)
    held = table.table.manifest()
    assert held.notes["buckets"] >= 4 and max(len(f) for f in held.parts.values()) <= 2
    found = {r["k"]: r["v"] for r in table.read().collect()}
    assert found == {k: max(0, (k - 10) // 50) for k in range(310)}
    assert max(held.rows.values()) <= 100 + 50


def test_insert_ignore_takes_the_first(spark, tmp_path, rows):
    table = keyed(spark, tmp_path / "t", buckets=4)
    first = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "x")], "k bigint, v string")
    assert rows(table.insert_ignore(first, ["v"])) == [(1, "a"), (None, "x"), (None, "x")]
    assert rows(table.insert_ignore(spark.createDataFrame([(1, "c"), (2, "d")], "k int, v string"))) == [(2, "d")]
    assert rows(table.read()) == [(1, "a"), (2, "d"), (None, "x"), (None, "x")]


def test_upserts_against_a_dictionary(spark, tmp_path):
    rng = random.Random(4)
    table, held = keyed(spark, tmp_path / "t", buckets=4, rows_per_bucket=40), {}
    for step in range(6):
        source = {rng.randrange(120): f"{step}-{k}" for k in range(25)}
        if step % 2:
            table.insert_ignore(spark.createDataFrame(list(source.items()), "k bigint, v string"))
            held = {**source, **held}
        else:
            table.upsert(spark.createDataFrame(list(source.items()), "k bigint, v string"))
            held.update(source)
        assert dict(map(tuple, table.read().collect())) == held and table.read().count() == len(held)


def test_ids_stay(spark, tmp_path, monkeypatch):
    ids = KeyMap(spark, str(tmp_path / "ids"), ["name"], buckets=4)
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "name string")
    first = dict((r["name"], r["id"]) for r in ids.assign(names("b", None, "d", "b")).collect())
    assert first == {None: 1, "b": 2, "d": 3}
    with monkeypatch.context() as patch:
        failing(patch, Published, "commit")
        with pytest.raises(Lost):
            ids.assign(names("a", "c"))
    second = dict((r["name"], r["id"]) for r in ids.assign(names("c", "a", None, "b")).collect())
    assert second == {**first, "a": 4, "c": 5}
    assert dict((r["name"], r["id"]) for r in ids.assign(names("a")).collect()) == second
    assert ids.read().count() == 5


def test_keys_over_batches(spark, tmp_path, rows):
    index = KeyIndex(spark, str(tmp_path / "keys"), ["a", "b"], buckets=4)
    frame = lambda *x: spark.createDataFrame(list(x), "a int, b string")
    assert rows(index.register(frame((1, "x"), (1, "x"), (2, "x"), (None, "x")), 0)) == [(1, "x", 2, 0, True), (2, "x", 1, 0, False)]
    expected = [(2, "x", 1, 0, True), (3, "x", 1, 1, False)]
    assert rows(index.register(frame((2, "x"), (3, "x"), (3, None)), 1)) == expected
    assert rows(index.register(frame((2, "x"), (3, "x")), 1)) == expected  # replayed
    assert rows(index.register(frame((3, "x")), 2)) == [(3, "x", 1, 1, True)]
    assert index.register(frame(), 3).count() == 0


def test_partials_read_changed_days_only(spark, tmp_path, rows):
    days = DayTable(spark, str(tmp_path / "days"), "ts")
    held = Partials(spark, str(tmp_path / "partials"), {"kind": F.col("kind")}, {"n": ("count", F.lit(1)), "total": ("sum", F.col("v")), "low": ("min", F.col("v"))})
    assert held.refresh(days) == []
    frame = lambda *x: spark.createDataFrame(list(x), "ts string, kind string, v int").withColumn("ts", F.to_timestamp("ts"))
    assert days.append(frame(("2024-01-01 10:00:00", "a", 3), ("2024-01-02 10:00:00", "a", 5), (None, "b", 7)), 0)
    assert len(held.refresh(days)) == 3 and held.refresh(days) == []
    before = held.table.manifest()
    assert days.append(frame(("2024-01-02 23:00:00", "a", 1), ("2024-01-03 00:00:00", "b", None)), 1)
    assert not days.append(frame(("2024-01-02 23:00:00", "a", 1)), 1)
    changed = held.refresh(days)
    assert sorted(changed) == ["2024-01-02", "2024-01-03"]
    after = held.table.manifest()
    assert after.parts["2024-01-01"] == before.parts["2024-01-01"] and after.parts["2024-01-02"] != before.parts["2024-01-02"]
    scanned = days.table.read_parts(days.table.manifest(), changed)
    assert all("2024-01-02" in f or "2024-01-03" in f for f in scanned.inputFiles())
    assert rows(held.merged([DAY, "kind"]).withColumn(DAY, F.col(DAY).cast("string"))) == [
        ("2024-01-01", "a", 1, 3, 3), ("2024-01-02", "a", 2, 6, 1), ("2024-01-03", "b", 1, None, None), (None, "b", 1, 7, 7),
    ]
    assert rows(held.merged(["kind"], ["n", "low"])) == [("a", 3, 1), ("b", 2, 7)]
    assert rows(held.average(["kind"], "total", "n", "average").withColumn("average", F.col("average").cast("string"))) == [("a", "3.00"), ("b", "3.50")]


def test_nested_bands_against_brute_force(spark):
    rng = random.Random(9)
    top = (1 << 32) - 1
    bands = [(0, top, "world"), (0, top, "globe"), (5, 4, "none"), (None, 9, "none"), (7, None, "none"), (top, top, "last"), (65536, 131071, "block")]
    for k in range(60):
        start = rng.choice([rng.randrange(1 << 32), 65536 * rng.randrange(4), 131072 + rng.randrange(300)])
        bands.append((start, min(top, start + rng.choice([0, 3, 40, 255, 65535, 200_000])), f"b{k}"))
    bands += bands[:3]
    frame = spark.createDataFrame(bands, "ip_from bigint, ip_to bigint, country string")
    flat = sorted(map(tuple, flatten_bands(frame, ["country"]).collect()))
    assert all(a[1] < b[0] for a, b in zip(flat, flat[1:]))
    valid = [b for b in bands if None not in b and b[0] <= b[1]]
    points = {p for a, b, _ in valid for e in (a, b) for p in (e - 1, e, e + 1) if 0 <= p <= top} | {rng.randrange(1 << 32) for _ in range(50)}
    for point in sorted(points):
        best = min(((b - a, -a, c) for a, b, c in valid if a <= point <= b), default=None)
        mine = [c for a, b, c in flat if a <= point <= b]
        assert mine == ([best[2]] if best else [])
    assert flatten_bands(frame.where("false"), ["country"]).count() == 0
