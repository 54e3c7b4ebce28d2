"""Ad clicks: decode messages, land them, enrich the waiting rows, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltwork.functions.agents import browser_family, device_type, os_family
from siltwork.functions.dates import time_of_day
from siltwork.functions.messages import decode_messages
from siltwork.functions.people import AGE_BAND_ORDER, TIME_OF_DAY_ORDER, age_group
from siltwork.operators import reports
from siltwork.operators.columns import shape
from siltwork.operators.geo import locate
from siltwork.operators.ledger import open_folders, read_folders
from siltwork.operators.merge import unprocessed
from siltwork.operators.partials import DayTable
from siltwork.plans.tables import CLICK_MESSAGE, CLICKS
from siltwork.published import Published
from siltwork.sources.jdbc import uploaded_on
from siltwork.streaming.batches import csv_sink, fan_out, json_sink, parquet_sink, staged_sink
from siltwork.streaming.queries import EVERY, BatchSink, start

NO_AGE = "None"


def decode_clicks(messages: DataFrame, keep_corrupt: bool = False) -> DataFrame:
    """Typed clicks from message bytes, on a batch or a stream."""
    return decode_messages(messages, CLICK_MESSAGE.schema(), keep_corrupt=keep_corrupt)


def table_route(path: str) -> BatchSink:
    """Stage clicks with the columns a new row gets by default: id, arrival time, status."""
    staged = staged_sink(path)
    return lambda batch, batch_id: staged(CLICKS.fill_absent(batch), batch_id)


def landing_sinks(base: str, day: dt.date, table_sink: BatchSink | None = None) -> BatchSink:
    """JSON, CSV or Parquet folder, or the table, chosen by batch id."""
    return fan_out(
        {
            "json": json_sink(base, day),
            "csv": csv_sink(base, day),
            "parquet": parquet_sink(base, day),
            "table": table_sink or table_route(f"{base}/table"),
        }
    )


def start_landing(
    messages: DataFrame, base: str, day: dt.date, checkpoint: str, every: str | None = EVERY
) -> StreamingQuery:
    return start(decode_clicks(messages), landing_sinks(base, day), checkpoint, every=every)


def enrich(clicks: DataFrame, bands: DataFrame) -> DataFrame:
    """Place, age band, time of day and device of each click."""
    placed = locate(clicks, bands, "ip_address", ("country", "city"))
    hour, agent = F.hour("activity_time"), F.col("log")
    described = placed.withColumns(
        {
            "age_group": age_group(F.col("age"), NO_AGE),
            "hours": hour,
            "time_of_day": time_of_day(hour),
            "device_type": device_type(agent),
            "os_family": os_family(agent),
            "browser_family": browser_family(agent),
        }
    )
    return shape(described, drop=("username", "created_at", "status"))


def waiting_clicks(clicks: DataFrame, ledger: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Uploaded clicks that are not in the ledger of processed ids."""
    return unprocessed(uploaded_on(clicks, day), ledger, "id")


def process_waiting(clicks: DataFrame, bands: DataFrame, target: str, day: dt.date | None = None) -> None:
    """Append the enriched form of every waiting click to the table at ``target``.

    That table holds the click ids, so it is its own ledger: one committed write
    both adds rows and marks them processed, and a rerun adds nothing twice.
    """
    spark = clicks.sparkSession
    try:
        done = spark.read.parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        done = clicks.select("id").where(F.lit(False))
    enrich(waiting_clicks(clicks, done, day), bands).write.mode("append").parquet(target)


def process_new(clicks: DayTable, bands: DataFrame, target: Published) -> DataFrame:
    """Append the enriched form of clicks in folders that ``target`` was not made of yet; these rows.

    The target's manifest names the folders it was made of: one commit adds rows and marks their folders
    done, and no folder that is done is read again.
    """
    now, held = clicks.table.manifest(), target.manifest()
    left = open_folders(now, held.notes.get("done", {}) if held else {})
    enriched = enrich(read_folders(clicks.table, now, left), bands)
    if not left and held:
        return enriched.limit(0)
    before = {part: set(folders) for part, folders in held.parts.items()} if held else {}
    made = target.append(enriched, F.to_date("activity_time"), done=now.parts)
    added = {part: [f for f in folders if f not in before.get(part, ())] for part, folders in made.parts.items()}
    return read_folders(target, made, added)


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "df_country": lambda clicks: reports.clicks_ranked(clicks, "country"),
    "df_city": lambda clicks: reports.clicks_ranked(clicks, "city"),
    "df_age_group": lambda clicks: reports.clicks_by_lists(
        clicks, ("age_group", AGE_BAND_ORDER), ("time_of_day", TIME_OF_DAY_ORDER)
    ),
    "df_year_month": lambda clicks: reports.clicks_by_month(clicks, "activity_time"),
}


def build_reports(enriched: DataFrame) -> dict[str, DataFrame]:
    """All click reports over enriched clicks that are already stored."""
    return {name: report(enriched) for name, report in REPORTS.items()}
