"""Linear regression with folds from one pass over the rows.

For every fold Spark aggregates counts, means and centred cross products of the features and the target; that is all a
linear fit, a ridge or elastic-net path, and the squared error on held-out rows need. A fold's training set is the sum of the
others' moments, so folds times grid costs one scan and a few solutions of small systems on the driver, which sees
folds * features^2 numbers. Meant for tens of features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Count, means, and sums of products of deviations from the means; the target is the last variable."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products)

    @classmethod
    def empty(cls, variables: int) -> "Moments":
        return cls(0, np.zeros(variables), np.zeros((variables, variables)))


@dataclass(frozen=True)
class Fit:
    intercept: float
    coefficients: np.ndarray


def fold_moments(df: DataFrame, features: Sequence[str], target: str, fold: Column | None = None) -> tuple[dict[int, Moments], int]:
    """Moments of each fold, and how many rows were left out because a value is NULL or NaN.

    ``fold`` numbers the folds; without it all rows are one. Rows whose fold is NULL count as left out.
    """
    names = [*features, target]
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]
    whole = F.lit(True)
    for i in range(len(names)):
        whole = whole & F.col(f"v{i}").isNotNull() & ~F.isnan(f"v{i}")
    rows = df.select(*values, (F.lit(0) if fold is None else fold).cast("int").alias("fold")).withColumn("whole", whole & F.col("fold").isNotNull())
    kept = [F.when(F.col("whole"), F.col(f"v{i}")).alias(f"v{i}") for i in range(len(names))]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    cells = [F.covar_pop(f"v{i}", f"v{j}").alias(f"c{i}_{j}") for i, j in pairs]
    means = [F.avg(f"v{i}").alias(f"m{i}") for i in range(len(names))]
    left_out = F.count_if(~F.col("whole")).alias("left_out")
    found = rows.select(*kept, "fold", "whole").groupBy("fold").agg(F.count_if("whole").alias("n"), left_out, *means, *cells).collect()
    out = {}
    for r in found:
        if r["n"]:
            products = np.zeros((len(names), len(names)))
            for i, j in pairs:
                products[i, j] = products[j, i] = r[f"c{i}_{j}"] * r["n"]
            out[r["fold"]] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(len(names))]), products)
    return out, sum(r["left_out"] for r in found)


def fit(moments: Moments, penalty: float = 0.0, l1_share: float = 0.0, sweeps: int = 10_000, settled: float = 1e-12) -> Fit:
    """Least squares with an elastic-net penalty on standardised features, as Spark's own regression defines it.

    A feature that does not vary gets the coefficient 0; of features that determine each other without a penalty the
    solution of least norm is taken.
    """
    width = len(moments.mean) - 1
    coefficients = np.zeros(width)
    spread = np.sqrt(np.diag(moments.products) / max(moments.n, 1))
    used = [i for i in range(width) if spread[i] > 1e-12 * max(1.0, abs(moments.mean[i]))]
    if moments.n and spread[-1] > 0 and used:
        scale = spread[used]
        r = moments.products[np.ix_(used, used)] / moments.n / np.outer(scale, scale)
        t = moments.products[used, -1] / moments.n / scale / spread[-1]
        strength = penalty / spread[-1]
        if l1_share == 0 or strength == 0:
            b = np.linalg.lstsq(r + strength * np.eye(len(used)), t, rcond=None)[0]
        else:
            b = _descend(r, t, strength * l1_share, strength * (1 - l1_share), sweeps, settled)
        coefficients[used] = b * spread[-1] / scale
    return Fit(float(moments.mean[-1] - coefficients @ moments.mean[:-1]), coefficients)


def _descend(r: np.ndarray, t: np.ndarray, l1: float, l2: float, sweeps: int, settled: float) -> np.ndarray:
    """Coordinate descent on the correlations of features with each other and with the target."""
    b = np.zeros(len(t))
    for _ in range(sweeps):
        moved = 0.0
        for i in range(len(t)):
            pull = t[i] - r[i] @ b + r[i, i] * b[i]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (r[i, i] + l2)
            moved, b[i] = max(moved, abs(new - b[i])), new
        if moved < settled:
            break
    return b


def squared_error(moments: Moments, model: Fit) -> float:
    """The sum of squared errors over the rows that ``moments`` stand for."""
    b = np.append(-model.coefficients, 1.0)
    off = moments.mean @ b - model.intercept
    return max(float(b @ moments.products @ b), 0.0) + moments.n * off * off


def cross_validated(
    df: DataFrame, features: Sequence[str], target: str, fold: Column, penalties: Sequence[float] = (0.0, 0.1), l1_shares: Sequence[float] = (0.0,)
) -> DataFrame:
    """One row per penalty and share: mean RMSE over the held-out folds, the fit on all rows, rows used and left out.

    Columns reg_param, elastic_net, rmse, intercept, coefficients (a map), rows_used, rows_left_out; NULL for rmse with fewer than two folds.
    """
    folds, left_out = fold_moments(df, features, target, fold)
    none = Moments.empty(len(features) + 1)
    everything = reduce(Moments.__add__, folds.values(), none)
    training = {k: reduce(Moments.__add__, (m for f, m in folds.items() if f != k), none) for k in folds}
    rows = []
    for share in l1_shares:
        for penalty in penalties:
            errors = [(squared_error(m, fit(training[k], penalty, share)) / m.n) ** 0.5 for k, m in folds.items()]
            final = fit(everything, penalty, share)
            named = dict(zip(features, map(float, final.coefficients), strict=True))
            score = float(np.mean(errors)) if len(folds) > 1 else None
            rows.append((float(penalty), float(share), score, final.intercept if everything.n else None, named if everything.n else None, everything.n, left_out))
    kinds = "reg_param double, elastic_net double, rmse double, intercept double, coefficients map<string,double>, rows_used bigint, rows_left_out bigint"
    return df.sparkSession.createDataFrame(rows, kinds)
