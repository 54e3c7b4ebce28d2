from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwork.learning import features, models
from siltwork.plans import finance


@pytest.fixture(scope="module")
def training(spark):
    """200 customers whose label follows a known line plus seeded noise."""
    noise = np.random.default_rng(7)
    data = []
    for i in range(200):
        speed, product, service = (int(v) for v in noise.integers(0, 11, 3))
        kind = "product_B" if i % 3 else "product_A"
        label = 100 + 5 * speed - 2 * product + 10 * (kind == "product_B") + float(noise.normal(0, 3))
        data.append((f"c{i}", speed, product, service, kind, label))
    columns = ["customer_id", *finance.SCORES, "product_type", "avg_amount_captured"]
    return spark.createDataFrame(data, columns).cache()


@pytest.fixture(scope="module")
def prepared(training):
    return models.prepare(training, "customer_id", finance.SCORES, "product_type", "avg_amount_captured")


@pytest.fixture(scope="module")
def matrix(prepared):
    rows = prepared.train.collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.avg_amount_captured for r in rows])


def test_split_is_disjoint_whole_and_stable(training):
    train, test = features.split_rows(training, ["customer_id"])
    again, _ = features.split_rows(training.repartition(7), ["customer_id"])
    ids = {r.customer_id for r in train.collect()}
    assert ids.isdisjoint(r.customer_id for r in test.collect())
    assert train.count() + test.count() == 200 and 130 < len(ids) < 190
    assert ids == {r.customer_id for r in again.collect()}


def test_scaling_uses_the_train_rows_and_population_spread(training):
    train, test = features.split_rows(training, ["customer_id"])
    name = finance.SCORES[0]
    x = np.array([r[0] for r in train.select(name).collect()], float)
    scaled = features.scale_columns(test, [name], train).join(test.select("customer_id", F.col(name).alias("raw")), "customer_id")
    for row in scaled.collect():
        assert row[name] == pytest.approx((row.raw - x.mean()) / x.std())


def test_a_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r.v for r in features.scale_columns(df, ["v"]).collect()] == [0.0, 0.0]


def test_the_first_category_is_left_out(spark):
    df = spark.createDataFrame([(1.0, "product_A"), (2.0, "product_B"), (3.0, "product_C")], "v double, c string")
    found = features.assemble(["v"], "c").fit(df).transform(df).orderBy("v")
    assert [list(r.features.toArray()) for r in found.collect()] == [[1, 0, 0], [2, 0, 1], [3, 1, 0]]


def test_leave_one_out_errors_equal_refitting_without_each_row(prepared, matrix):
    x, y = matrix
    found = models.leave_one_out_errors(prepared, (0.1, 10.0))
    for alpha, error in found.items():
        squares = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            mean_x, mean_y = x[keep].mean(0), y[keep].mean()
            c = x[keep] - mean_x
            slope = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ (y[keep] - mean_y))
            squares.append((y[i] - mean_y - (x[i] - mean_x) @ slope) ** 2)
        assert error == pytest.approx(np.mean(squares), rel=1e-9)


def test_linear_ridge_and_lasso_coefficients(prepared, matrix):
    x, y = matrix
    found = models.fit_all(prepared, {n: m for n, m in models.standard_models(prepared, 5).items() if n != "RandomForestRegressor"})
    c, d = x - x.mean(0), y - y.mean()
    assert found["LinearRegression"].coefficients.toArray() == pytest.approx(np.linalg.lstsq(c, d, rcond=None)[0], rel=1e-6)
    errors = models.leave_one_out_errors(prepared, models.RIDGE_ALPHAS)
    alpha = min(errors, key=errors.get)
    ridge = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ d)
    assert found["RidgeCV"].coefficients.toArray() == pytest.approx(ridge, rel=1e-5)
    slope = np.zeros(x.shape[1])
    for _ in range(2000):  # coordinate descent on 1/(2n) |d - cw|^2 + alpha |w|_1
        for j in range(len(slope)):
            rest = d - c @ slope + c[:, j] * slope[j]
            rho = (c[:, j] @ rest) / len(d)
            slope[j] = np.sign(rho) * max(abs(rho) - models.LASSO_ALPHA, 0) / ((c[:, j] @ c[:, j]) / len(d))
    assert found["Lasso"].coefficients.toArray() == pytest.approx(slope, abs=1e-3)


def test_scores_weights_and_predictions(training):
    result = finance.compare_models(training, trees=5)
    found = {(r.model, r.side): r.r2 for r in result.scores.collect()}
    assert len(found) == 8 and found["LinearRegression", "test"] > 0.8
    heavy = result.weights.where("model = 'LinearRegression'").collect()
    assert heavy[0].feature == finance.SCORES[0] and [r.weight for r in heavy] == sorted((r.weight for r in heavy), reverse=True)
    assert {r.feature for r in heavy} == {*finance.SCORES, "product_type_product_B"}
    assert result.predictions.count() == 4 * 200


def test_r_squared_of_a_perfect_and_a_flat_guess(spark):
    df = spark.createDataFrame([("p", 1.0, 1.0), ("p", 3.0, 3.0), ("m", 1.0, 2.0), ("m", 3.0, 2.0), ("c", 1.0, 1.0)], "k string, y double, prediction double")
    assert {r.k: r.r2 for r in models.r_squared(df, "y", by=["k"]).collect()} == {"p": 1.0, "m": 0.0, "c": None}
