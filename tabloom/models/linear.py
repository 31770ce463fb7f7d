"""Linear models from moments gathered in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Moments:
    """Rows, means and population co-moments of features and target: all a linear fit needs."""

    n: int
    x_mean: np.ndarray
    y_mean: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float


def gather_moments(df: DataFrame, features: Sequence[str], target: str) -> Moments:
    """One aggregate: a row of (d+1)(d+4)/2 numbers reaches the driver, whatever the table size."""
    names = [*features, target]
    known = df.dropna(subset=names)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = known.agg(
        F.count("*"),
        *[F.avg(c) for c in names],
        *[F.covar_pop(names[i], names[j]) for i, j in pairs],
    ).first()
    if not row[0]:
        raise ValueError("no complete rows to fit on")
    d = len(names)
    means, cov = np.array(row[1 : d + 1], float), np.empty((d, d))
    for value, (i, j) in zip(row[d + 1 :], pairs, strict=True):
        cov[i, j] = cov[j, i] = value
    return Moments(row[0], means[:-1], means[-1], cov[:-1, :-1], cov[:-1, -1], cov[-1, -1])


@dataclass
class LinearModel:
    """Intercept and slopes; predicts with a Column expression."""

    features: Sequence[str]
    intercept: float
    slopes: np.ndarray
    output: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        total = F.lit(float(self.intercept))
        for name, slope in zip(self.features, self.slopes, strict=True):
            total = total + F.col(name) * F.lit(float(slope))
        return df.withColumn(self.output, total)

    def table(self, like: DataFrame) -> DataFrame:
        rows = [("(intercept)", float(self.intercept))]
        rows += [(n, float(s)) for n, s in zip(self.features, self.slopes, strict=True)]
        return like.sparkSession.createDataFrame(rows, "term string, coefficient double")


def least_squares(df: DataFrame, features: Sequence[str], target: str) -> LinearModel:
    """Ordinary least squares with an intercept, by the normal equations."""
    m = gather_moments(df, features, target)
    slopes = np.linalg.solve(m.xx, m.xy)
    return LinearModel(features, m.y_mean - slopes @ m.x_mean, slopes)


def gradient_descent(
    df: DataFrame, features: Sequence[str], target: str, rate: float = 0.3, steps: int = 100
) -> tuple[LinearModel, DataFrame]:
    """Batch gradient descent on standardised features; returns (model, loss per step).

    The loss and its gradient depend on the rows only through the moments, so the table is
    read once and the steps run on d numbers.
    """
    m = gather_moments(df, features, target)
    std = np.sqrt(np.diag(m.xx))
    std[std == 0] = 1.0
    gram, cross = m.xx / np.outer(std, std), m.xy / std
    slopes, intercept, losses = np.zeros(len(std)), 0.0, []
    for _ in range(steps):
        # mean squared error with centred features: the intercept and slopes separate
        losses.append(slopes @ gram @ slopes - 2 * slopes @ cross + m.yy + (m.y_mean - intercept) ** 2)
        intercept -= 2 * rate * (intercept - m.y_mean)
        slopes = slopes - 2 * rate * (gram @ slopes - cross)
    curve = df.sparkSession.createDataFrame(
        [(i, float(v)) for i, v in enumerate(losses)], "step int, loss double"
    )
    raw = slopes / std
    return LinearModel(features, intercept - raw @ m.x_mean, raw), curve
