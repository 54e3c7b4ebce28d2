"""Card charges: load files under contract, build the feature table, fit models."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltwork.learning.models import (
    TREES, FeatureSet, fit_all, predictions, prepare, scores, standard_models, weights,
)
from siltwork.operators.keyed import KeyedTable
from siltwork.operators.merge import upsert
from siltwork.operators.reports import average_by
from siltwork.plans.tables import CHARGES, SATISFACTION
from siltwork.shared import write_shared
from siltwork.sources.files import read_csv
from siltwork.sources.landing import archive_folder, stream_landing
from siltwork.streaming.batches import staged_sink
from siltwork.streaming.queries import start

SCORES = ("customer_satisfaction_speed", "customer_satisfaction_product", "customer_satisfaction_service")
FOLDERS = {"in_charge": ("charge", CHARGES), "customer_satisfaction": ("satisfaction", SATISFACTION)}


def load_folders(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Each landing folder as one typed table, read in one scan."""
    return {
        table: read_csv(spark, f"{base}/{folder}/*.csv", contract) for table, (folder, contract) in FOLDERS.items()
    }


def start_load(
    spark: SparkSession, base: str, table: str, target: str, archive: str, day: dt.date, checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Load new files of one table's folder and archive them under the day."""
    folder, contract = FOLDERS[table]
    files = stream_landing(spark, f"{base}/{folder}", contract.schema(), archive_folder(archive, day))
    return start(contract.enforce(files), staged_sink(target), checkpoint, every=every)


def captured_averages(charges: DataFrame) -> DataFrame:
    """Average captured amount per customer over settled charges."""
    settled = charges.where(
        (F.col("status") == "succeeded")
        & (F.col("outcome_network_status") == "approved_by_network")
        & F.col("paid")
    )
    return average_by(settled, ["customer_id"], "amount_captured", "avg_amount_captured")


def training_rows(charges: DataFrame, satisfaction: DataFrame) -> DataFrame:
    """Distinct satisfaction rows of customers with settled charges, with their average."""
    joined = satisfaction.join(captured_averages(charges), "customer_id")
    return joined.select("customer_id", *SCORES, "product_type", "avg_amount_captured").distinct()


def refresh_training(training: DataFrame, charges: DataFrame, satisfaction: DataFrame) -> DataFrame:
    """The training table after an upsert by customer."""
    return upsert(training, training_rows(charges, satisfaction), ["customer_id"])


def refresh_training_in(path: str, charges: DataFrame, satisfaction: DataFrame) -> DataFrame:
    """The training table kept by customer at ``path`` after an upsert that rewrites the touched buckets only."""
    held = KeyedTable(charges.sparkSession, path, ["customer_id"])
    held.upsert(training_rows(charges, satisfaction), on_duplicate="fail")
    return held.read()


@dataclass(frozen=True)
class Comparison:
    features: FeatureSet
    predictions: DataFrame
    scores: DataFrame
    weights: DataFrame


def compare_models(training: DataFrame, trees: int = TREES) -> Comparison:
    """Fit the four models and report scores, weights and predictions.

    The training rows are written first: every fit and every report reads them.
    """
    features = prepare(write_shared(training, "training"), "customer_id", SCORES, "product_type", "avg_amount_captured")
    models = fit_all(features, standard_models(features, trees))
    predicted = predictions(features, models)
    return Comparison(features, predicted, scores(predicted), weights(training, features, models))
