"""Cross-validation of linear models from one aggregate.

The sums of all products of features and label are gathered for each fold in one pass.  Those of the other folds are
the total less the fold's own, and give coefficients for every penalty; the fold's own give their squared error.  No
row is read again, however many folds and penalties there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.learning.features import SEED

FOLDS = 5


def fold_of(key: Sequence[str], folds: int = FOLDS, seed: int = SEED) -> Column:
    """A row's fold by a hash of its key."""
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(folds)).cast("int")


def products_by_fold(df: DataFrame, features: Sequence[str], label: str, fold: Column) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The means of features and label, and for each fold the sums of all products of (1, features, label) less these means.

    Rows with a null in any of them or in the fold are left out.  What comes to the driver is a matrix for each fold.
    """
    names = [*features, label]
    rows = df.select(fold.alias("_fold"), *(F.col(c).cast("double").alias(f"_z{i}") for i, c in enumerate(names))).dropna()
    means = rows.agg(*(F.coalesce(F.avg(f"_z{i}"), F.lit(0.0)) for i in range(len(names)))).first()
    z = [F.lit(1.0), *(F.col(f"_z{i}") - float(m) for i, m in enumerate(means))]
    places = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    sums = rows.groupBy("_fold").agg(*(F.sum(z[i] * z[j]) for i, j in places)).collect()
    out = {}
    for row in sums:
        matrix = np.zeros((len(z), len(z)))
        for (i, j), value in zip(places, row[1:]):
            matrix[i, j] = matrix[j, i] = value
        out[row[0]] = matrix
    return np.array(means), out


def ridge_fit(products: np.ndarray, alpha: float) -> np.ndarray:
    """Intercept and slopes with a penalty of ``alpha`` on the slopes; 0 is plain least squares."""
    count, sums = products[0, 0], products[0, 1:]
    centred = products[1:, 1:] - np.outer(sums, sums) / count
    slopes = np.linalg.solve(centred[:-1, :-1] + alpha * np.eye(len(centred) - 1), centred[:-1, -1])
    return np.concatenate([[(sums[-1] - sums[:-1] @ slopes) / count], slopes])


def squared_error(products: np.ndarray, coefficients: np.ndarray) -> float:
    """Summed squared error over the rows the products were taken of."""
    signs = np.concatenate([-coefficients, [1.0]])
    return float(signs @ products @ signs)


def cross_validated(df: DataFrame, features: Sequence[str], label: str, alphas: Sequence[float], fold: Column) -> DataFrame:
    """``alpha``, ``fold``, ``rows``, ``mean_squared_error`` and a slope for each feature, fitted on all other folds.

    Folds without other rows are left out.
    """
    _, by_fold = products_by_fold(df, features, label, fold)
    total = sum(by_fold.values()) if by_fold else None
    rows = []
    for name, own in sorted(by_fold.items()):
        if total[0, 0] == own[0, 0]:
            continue
        for alpha in alphas:
            fitted = ridge_fit(total - own, alpha)
            rows.append((float(alpha), name, int(own[0, 0]), float(squared_error(own, fitted) / own[0, 0]), *map(float, fitted[1:])))
    slopes = ", ".join(f"slope_{c} double" for c in features)
    return df.sparkSession.createDataFrame(rows, f"alpha double, fold int, rows bigint, mean_squared_error double, {slopes}")


def best_penalty(errors: Mapping[float, float]) -> float:
    """The penalty of least error, of equal ones the smallest."""
    return min(sorted(errors), key=errors.get)
