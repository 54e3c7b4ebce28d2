from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltwork import shared
from siltwork.plans import clicks, finance, words
from siltwork.plans.tables import SATISFACTION
from siltwork.plans.users import keyed_append_sink
from siltwork.sinks import files, jdbc as jdbc_sink, kafka as kafka_sink
from siltwork.sources import files as file_sources, jdbc, kafka, landing
from siltwork.streaming import batches
from siltwork.streaming.queries import run_available, start

DAY = dt.date(2024, 9, 4)

# Three small texts; words starting with s are counted by hand: 3, then 5, then 10.
TEXTS = ("Sun shines. The sea is calm.", "42 stars. Night\nsets. soon", "SAND and salt. see snow  sky.\n7.")
TOTALS = (3, 5, 10)


def total_with_s(spark, table):
    return words.occurrences_with_prefix(spark.table(table), "s").collect()[0][0]


def put(folder: Path, name: str, text: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_word_count_grows_with_each_file(spark, tmp_path):
    for n, (text, total) in enumerate(zip(TEXTS, TOTALS)):
        put(tmp_path / "in", f"{n}.txt", text)
        words.count_files(spark, str(tmp_path / "in"), "batch_words")
        assert total_with_s(spark, "batch_words") == total


def test_word_stream_keeps_counts_over_restarts(spark, tmp_path):
    for n, (text, total) in enumerate(zip(TEXTS, TOTALS)):
        put(tmp_path / "in", f"{n}.txt", text)
        words.count_stream(spark, str(tmp_path / "in"), "stream_words", str(tmp_path / "check")).awaitTermination()
        assert total_with_s(spark, "stream_words") == total
    words.count_files(spark, str(tmp_path / "in"), "twin_words")
    assert spark.table("stream_words").exceptAll(spark.table("twin_words")).isEmpty()


def test_a_running_stream_can_be_stopped(spark, tmp_path):
    put(tmp_path / "in", "a.txt", TEXTS[0])
    query = words.count_stream(spark, str(tmp_path / "in"), "live_words", str(tmp_path / "check"), every="1 second")
    query.processAllAvailable()
    assert query.isActive and total_with_s(spark, "live_words") == 3
    query.stop()
    assert not query.isActive


def test_every_batch_sink_leaves_the_same_rows_after_a_replay(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    base = str(tmp_path)
    sinks = {
        "json": batches.json_sink(base, DAY),
        "csv": batches.csv_sink(base, DAY),
        "parquet": batches.parquet_sink(base, DAY),
        "staged": batches.staged_sink(f"{base}/staged"),
        "replaced": batches.replace_sink(f"{base}/replaced"),
    }
    for sink in sinks.values():
        sink(df, 3)
        sink(df, 3)
    paths = {kind: files.landing_path(base, DAY, 3, kind) for kind in ("json", "csv", "parquet")}
    reader = spark.read.schema(df.schema)
    back = {
        "json": reader.json(paths["json"]),
        "parquet": spark.read.parquet(paths["parquet"]),
        "staged": spark.read.parquet(f"{base}/staged").select("id", "name"),
        "replaced": spark.read.parquet(f"{base}/replaced"),
        "csv": spark.read.schema(df.schema).option("header", True).option("sep", "|").csv(paths["csv"]),
    }
    for kind, frame in back.items():
        assert sorted(map(tuple, frame.collect()), key=str) == [(1, "a"), (2, None)], kind


def test_staged_sink_keeps_other_batches(spark, tmp_path):
    sink = batches.staged_sink(str(tmp_path / "s"))
    one, two = spark.range(2), spark.range(3)
    sink(one, 0)
    sink(two, 1)
    sink(one, 0)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 5


def test_routes_depend_on_the_batch_id_alone():
    assert [batches.route_of(n) for n in range(5)] == ["json", "csv", "parquet", "table", "table"]
    assert [batches.route_of(n) for n in range(10, 13)] == ["json", "csv", "parquet"]


def test_click_messages_land_in_each_kind_of_sink(spark, tmp_path):
    base, source = str(tmp_path / "out"), str(tmp_path / "in")
    stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(source + "*")
    for n in range(4):
        message = f'{{"username":"u{n}","age":{n + 20},"activity_time":"2024-01-0{n + 1} 10:00:00"}}'
        spark.createDataFrame([(message.encode(),)], "value binary").coalesce(1).write.parquet(f"{source}{n}")
        stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(source + "*")
        clicks.start_landing(stream, base, DAY, str(tmp_path / "check"), every=None).awaitTermination()
    day = Path(base) / "input_2024-09-04"
    assert sorted(p.name for p in day.iterdir()) == ["batch_0.json", "batch_1.csv", "batch_2.parquet"]
    row = spark.read.parquet(f"{base}/table").collect()[0]
    assert row.username == "u3" and row.status == "uploaded" and len(row.id) == 36 and row.created_at is not None


def test_waiting_clicks_are_processed_once(spark, tmp_path):
    schema = "id string, username string, age int, ip_address string, activity_time timestamp, log string, created_at timestamp, status string"

    def stored(*ids):
        rows = [(i, "u", 30, "1.2.3.4", dt.datetime(2024, 1, 1, 10), "x", dt.datetime(2024, 1, 1), s) for i, s in ids]
        return spark.createDataFrame(rows, schema)

    bands = spark.createDataFrame([(16909060, 16909065, "A", "a")], "ip_from bigint, ip_to bigint, country string, city string")
    target = str(tmp_path / "enriched")
    first = stored(("1", "uploaded"), ("2", "transformed"))
    clicks.process_waiting(first, bands, target)
    clicks.process_waiting(first, bands, target)
    clicks.process_waiting(first.union(stored(("3", "uploaded"))), bands, target)
    assert sorted((r.id, r.country, r.age_group) for r in spark.read.parquet(target).collect()) == [
        ("1", "A", "26-40"), ("3", "A", "26-40")]


def test_enrichment_gives_the_same_rows_on_a_stream(spark, tmp_path):
    data = [(f'{{"username":"u{n}","age":{n * 9},"activity_time":"2024-01-01 {n:02d}:00:00","ip_address":"1.2.3.{n}",'
             f'"log":"Mozilla/5.0 (Linux; Android 9; Tablet) Chrome/9{n}.0 Safari/537.36"}}').encode() for n in range(10)]
    spark.createDataFrame([(d,) for d in data], "value binary").write.parquet(str(tmp_path / "in"))
    bands = spark.createDataFrame([(16909060, 16909065, "A", "a", "r")], "ip_from bigint, ip_to bigint, country string, city string, region string")
    stream = spark.readStream.schema("value binary").parquet(str(tmp_path / "in"))
    sink = batches.staged_sink(str(tmp_path / "out"))
    run_available(clicks.enrich(clicks.decode_clicks(stream), bands), sink, str(tmp_path / "check"))
    batch = clicks.enrich(clicks.decode_clicks(spark.read.parquet(str(tmp_path / "in"))), bands)
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*batch.columns)
    assert streamed.count() == 10 and streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert {r.country for r in batch.collect()} == {"A", "Unknown"}


def test_to_all_computes_a_batch_once_and_lets_it_go(spark, tmp_path):
    seen = []
    sink = batches.to_all(lambda df, n: seen.append((df.is_cached, n)), lambda df, n: seen.append((df.count(), n)))
    sink(spark.range(4), 7)
    assert seen == [(True, 7), (4, 7)]


def test_keyed_append_stream(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    run_available(stream, keyed_append_sink(str(tmp_path / "out")), str(tmp_path / "check"))
    run_available(stream, keyed_append_sink(str(tmp_path / "out")), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_stream_failure_reaches_the_caller(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))

    def broken(batch, batch_id):
        raise ValueError("sink down")

    with pytest.raises(PySparkException, match="sink down"):
        run_available(stream, broken, str(tmp_path / "check"))


def test_landed_files_are_loaded_once_and_archived(spark, tmp_path):
    folder = tmp_path / "land" / "satisfaction"
    header = "customer_id,customer_satisfaction_speed,customer_satisfaction_product,customer_satisfaction_service,product_type\n"
    for n in range(3):
        put(folder, f"{n}.csv", f"{header}00000000-0000-4000-8000-00000000000{n},1,2,3,product_A\n")
        finance.start_load(
            spark, str(tmp_path / "land"), "customer_satisfaction", str(tmp_path / "table"), str(tmp_path / "archive"),
            DAY, str(tmp_path / "check"),
        ).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 3 and table.select("customer_id").distinct().count() == 3
    archived = list((tmp_path / "archive" / "date_2024-09-04").rglob("*.csv"))
    assert archived and all(a.name in {"0.csv", "1.csv", "2.csv"} for a in archived)


GOOD_CSV = (
    "customer_id,customer_satisfaction_speed,customer_satisfaction_product,customer_satisfaction_service,product_type\n"
    "00000000-0000-4000-8000-000000000001,1,2,3,product_A\n"
)


def test_csv_load_is_all_or_nothing(spark, tmp_path):
    put(tmp_path, "good.csv", GOOD_CSV)
    assert file_sources.read_csv(spark, str(tmp_path / "good.csv"), SATISFACTION).count() == 1
    put(tmp_path, "bad.csv", GOOD_CSV + "00000000-0000-4000-8000-000000000002,many,2,3,product_B\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        file_sources.read_csv(spark, str(tmp_path / "bad.csv"), SATISFACTION).collect()
    put(tmp_path, "null.csv", GOOD_CSV + "00000000-0000-4000-8000-000000000002,,2,3,product_B\n")
    with pytest.raises(PySparkException, match="not_null"):
        file_sources.read_csv(spark, str(tmp_path / "null.csv"), SATISFACTION).collect()


def test_csv_split_reports_bad_fields_and_short_rows(spark, tmp_path):
    put(tmp_path, "mixed.csv", GOOD_CSV + "17,many,2,3,product_B\n00000000-0000-4000-8000-000000000003,1\n")
    good, bad = file_sources.read_csv_split(spark, str(tmp_path / "mixed.csv"), SATISFACTION)
    assert [r.customer_satisfaction_speed for r in good.collect()] == [1]
    reasons = {r.customer_id: r.violations for r in bad.collect()}
    assert reasons["17"] == ["customer_id:type", "customer_satisfaction_speed:type"]
    assert "row:malformed" in reasons["00000000-0000-4000-8000-000000000003"]


def test_files_are_routed_by_folder(spark, tmp_path):
    put(tmp_path / "charge", "a.csv", "x\n")
    put(tmp_path / "other", "b.csv", "y\n")
    routed = file_sources.route_by_path(spark.read.text(f"{tmp_path}/*"), {"charge/": "in_charge"}, "customer_satisfaction")
    assert {(r.value, r.target_table) for r in routed.collect()} == {("x", "in_charge"), ("y", "customer_satisfaction")}
    assert file_sources.with_source_file(spark.read.text(f"{tmp_path}/charge")).collect()[0].source_file.endswith("a.csv")


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError, match="users has no rows"):
        files.require_rows(spark.range(0), "users")
    assert files.require_rows(spark.range(1)).count() == 1


def test_counted_needs_no_second_pass(spark, tmp_path):
    df, seen = files.counted(spark.range(7), "seven")
    files.write_parquet(df, str(tmp_path / "x"), max_records_per_file=2)
    assert seen.get["amount"] == 7
    assert len(list((tmp_path / "x").glob("*.parquet"))) >= 4


def test_append_rows_through_any_format(spark, tmp_path):
    for _ in range(2):
        files.append_rows(spark.range(2), str(tmp_path / "a"), "json")
    assert spark.read.json(str(tmp_path / "a")).count() == 4


def test_jdbc_options():
    assert jdbc.scan_options("jdbc:x", "t", "id", 0, 100, 4) == {
        "url": "jdbc:x", "dbtable": "t", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError, match="go together"):
        jdbc.scan_options("jdbc:x", "t", "id", 0)
    assert jdbc_sink.sink_options("jdbc:x", "t", 100, True, 8, {"user": "u"}) == {
        "url": "jdbc:x", "dbtable": "t", "batchsize": "100", "user": "u", "truncate": "true", "numPartitions": "8"}


def test_topic_options():
    assert kafka.topic_options("h:1", "t", ending="latest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest"}
    with pytest.raises(ValueError):
        kafka.topic_options("", "t")
    options = kafka_sink.producer_options("h:1", "t")
    assert options["kafka.acks"] == "1" and options["kafka.batch.size"] == "32768"


def test_ready_probe_and_day_filter_push_down(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 10:00:00' AS created, 'uploaded' AS status, 1 AS id").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert jdbc.ready_on(table, dt.date(2024, 1, 2)).collect()[0].ready is True
    assert jdbc.ready_on(table, dt.date(2024, 1, 3)).collect()[0].ready is False
    waiting = jdbc.uploaded_on(table, dt.date(2024, 1, 2), created_col="created")
    plan = waiting._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created" in plan and "EqualTo(status,uploaded)" in plan and waiting.count() == 1


def test_archive_folder_name():
    assert landing.archive_folder("/a/", DAY) == "/a/date_2024-09-04"


def test_shared_folder_is_the_named_one(spark, tmp_path):
    assert spark.conf.get(shared.FOLDER_SETTING) in shared.shared_root(spark)
    table = shared.write_shared(spark.range(3), "probe")
    assert table.count() == 3 and shared.shared_root(spark) in table.inputFiles()[0]
    assert shared.shared_path(spark, "a") != shared.shared_path(spark, "a")


def test_start_names_the_query(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in")).withColumn("x", F.lit(1))
    query = start(stream, batches.replace_sink(str(tmp_path / "out")), str(tmp_path / "c"), name="probe", every=None)
    query.awaitTermination()
    assert query.name == "probe"
