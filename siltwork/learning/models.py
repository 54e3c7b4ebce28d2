"""Several regression models over one feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.base import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.learning.features import FEATURES, SEED, assemble, scale_columns, split_rows
from siltwork.shared import write_shared

# Hyper-parameters of the four models.
TREES = 2000
RIDGE_ALPHAS = (0.1, 1.0, 10.0)
LASSO_ALPHA = 2.0

PREDICTION = "prediction"


@dataclass(frozen=True)
class FeatureSet:
    """Train and test rows with a feature vector, and the names of its entries."""

    train: DataFrame
    test: DataFrame
    names: Sequence[str]
    label: str


def prepare(df: DataFrame, key: str, numeric: Sequence[str], category: str, label: str) -> FeatureSet:
    """Split, scale by the training rows, encode and assemble.

    Both sides are written once: penalty choice, fits, predictions and scores read them.  Categories and label are set before the split, so a category that occurs
    only among the test rows still has its place in the vector.
    """
    rows = df.select(key, *numeric, category, F.col(label).cast("double").alias(label))
    rows = rows.withColumns({c: F.col(c).cast("double") for c in numeric})
    train, test = split_rows(rows, [key])
    assembler = assemble(numeric, category).fit(rows.select(*numeric, category))
    others = assembler.stages[0].labels[:-1]
    names = [*numeric, *(f"{category}_{value}" for value in others)]
    return FeatureSet(
        write_shared(assembler.transform(scale_columns(train, numeric, train)).select(key, label, FEATURES), "train"),
        write_shared(assembler.transform(scale_columns(test, numeric, train)).select(key, label, FEATURES), "test"),
        names,
        label,
    )


def ridge_penalty(alpha: float, label_spread: float, rows: int) -> float:
    """Spark's ``regParam`` for a ridge penalty of ``alpha`` on the summed squared error.

    Spark divides the error by the row count and works on a label scaled by its
    population deviation.
    """
    return alpha * label_spread / rows


def leave_one_out_errors(features: FeatureSet, alphas: Sequence[float]) -> dict[float, float]:
    """Mean squared error of ridge regression with each row predicted by all others.

    No refit is needed: a row's error is its residual over one minus its
    leverage.  One pass gathers the covariances, whose size follows the feature
    count, and one pass sums the errors of every penalty.
    """
    width = range(len(features.names))
    xs = [f"_x{i}" for i in width]
    entry = vector_to_array(FEATURES)
    rows = features.train.select(F.col(features.label).alias("_y"), *(entry[i].alias(xs[i]) for i in width))
    pairs = {(a, b): F.covar_pop(a, b) for a in xs for b in [*xs, "_y"]}
    means = {c: F.avg(c) for c in [*xs, "_y"]}
    found = rows.agg(F.count("*"), *means.values(), *pairs.values()).first()
    count, mean, moment = found[0], dict(zip(means, found[1:])), dict(zip(pairs, found[1 + len(means):]))
    inner = np.array([[moment[a, b] for b in xs] for a in xs]) * count
    cross = np.array([moment[a, "_y"] for a in xs]) * count
    centred = [F.col(x) - mean[x] for x in xs]

    def squared_error(alpha: float) -> Column:
        inverse = np.linalg.inv(inner + alpha * np.eye(len(xs)))
        slope = inverse @ cross
        residual, leverage = F.col("_y") - mean["_y"], F.lit(1.0 / count)
        for i in width:
            residual = residual - centred[i] * float(slope[i])
            leverage = leverage + centred[i] * sum((centred[j] * float(inverse[i, j]) for j in width), F.lit(0.0))
        error = residual / (1 - leverage)
        return F.avg(error * error)

    errors = rows.agg(*(squared_error(a) for a in alphas)).first()
    return dict(zip(alphas, errors))


def standard_models(features: FeatureSet, trees: int = TREES) -> dict[str, Estimator]:
    """Random forest, plain, ridge (penalty by leave-one-out error) and lasso regression."""
    label = features.label
    common = {"featuresCol": FEATURES, "labelCol": label, "predictionCol": PREDICTION}
    spread, rows = features.train.agg(F.stddev_pop(label), F.count(label)).first()
    errors = leave_one_out_errors(features, RIDGE_ALPHAS)
    penalty = ridge_penalty(min(errors, key=errors.get), spread, rows)
    return {
        "RandomForestRegressor": RandomForestRegressor(numTrees=trees, seed=SEED, **common),
        "LinearRegression": LinearRegression(regParam=0.0, solver="normal", **common),
        "RidgeCV": LinearRegression(
            elasticNetParam=0.0, regParam=penalty, standardization=False, solver="normal", **common
        ),
        "Lasso": LinearRegression(elasticNetParam=1.0, regParam=LASSO_ALPHA, standardization=False, **common),
    }


def fit_all(features: FeatureSet, estimators: Mapping[str, Estimator]) -> dict[str, Model]:
    """Fit each estimator on the kept training rows, all at once.

    Each fit runs its jobs from a thread of its own, in a pool of its name where the session schedules fairly, so that
    one fit's last tasks do not leave the cluster idle.
    """
    train = features.train.persist(StorageLevel.MEMORY_AND_DISK)
    context = train.sparkSession.sparkContext

    def fit(name: str) -> Model:
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return estimators[name].fit(train)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)

    try:
        with ThreadPoolExecutor(max(1, len(estimators))) as threads:
            started = {name: threads.submit(inheritable_thread_target(train.sparkSession)(fit), name) for name in estimators}
            return {name: started[name].result() for name in estimators}
    finally:
        train.unpersist()


def r_squared(df: DataFrame, label: str, prediction: str = PREDICTION, by: Sequence[str] = ()) -> DataFrame:
    """1 - squared error / squared distance from the mean, per group of ``by``, in one pass."""
    y, p = F.col(label), F.col(prediction)
    error = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg((F.lit(1.0) - F.try_divide(error, spread)).alias("r2"))


def predictions(features: FeatureSet, models: Mapping[str, Model]) -> DataFrame:
    """True and predicted value of every train and test row under every model."""
    parts = []
    for name, model in models.items():
        for side, rows in (("train", features.train), ("test", features.test)):
            parts.append(
                model.transform(rows).select(
                    F.lit(name).alias("model"),
                    F.lit(side).alias("side"),
                    F.col(features.label).alias("true_value"),
                    F.col(PREDICTION).alias("predicted_value"),
                )
            )
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def scores(predicted: DataFrame) -> DataFrame:
    """R² of each model on the train and on the test rows."""
    return r_squared(predicted, "true_value", "predicted_value", ["model", "side"])


def weights(df: DataFrame, features: FeatureSet, models: Mapping[str, Model]) -> DataFrame:
    """Importance or coefficient of each feature per model, largest first.

    One row per model and feature entry, so its size follows the column count.
    """
    rows = []
    for name, model in models.items():
        values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
        rows += [(name, feature, float(value)) for feature, value in zip(features.names, values.toArray())]
    table = df.sparkSession.createDataFrame(rows, "model string, feature string, weight double")
    return table.orderBy("model", F.desc("weight"))


