"""Baselines, cross-validation, grid search and model tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Protocol

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach_group_stats
from .metrics import regression_scores


class Model(Protocol):
    def transform(self, df: DataFrame) -> DataFrame: ...


class Learner(Protocol):
    """Anything that fits a table and returns something that scores one."""

    def fit(self, df: DataFrame) -> Model: ...


class MeanBaseline:
    """Predicts the train mean."""

    def __init__(self, target: str, output: str = "prediction"):
        self.target, self.output = target, output

    def fit(self, df: DataFrame) -> MeanBaseline:
        fitted = MeanBaseline(self.target, self.output)
        fitted.mean = df.agg(F.avg(self.target)).first()[0]
        return fitted

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.output, F.lit(self.mean))


class MajorityBaseline:
    """Predicts the most frequent train class (the smallest label among ties)."""

    def __init__(self, target: str, output: str = "prediction"):
        self.target, self.output = target, output

    def fit(self, df: DataFrame) -> MajorityBaseline:
        fitted = MajorityBaseline(self.target, self.output)
        counts = df.groupBy(self.target).agg(F.count("*").alias("n"))
        fitted.label = counts.orderBy(F.desc("n"), self.target).first()[0]
        return fitted

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.output, F.lit(self.label))


class GroupMeanBaseline:
    """Predicts the train mean of the row's group, or the overall mean for a new group."""

    def __init__(self, target: str, by: Sequence[str], output: str = "prediction"):
        self.target, self.by, self.output = target, list(by), output

    def fit(self, df: DataFrame) -> GroupMeanBaseline:
        fitted = GroupMeanBaseline(self.target, self.by, self.output)
        fitted.table = df.groupBy(*self.by).agg(F.avg(self.target).alias(self.output))
        fitted.mean = df.agg(F.avg(self.target)).first()[0]
        return fitted

    def transform(self, df: DataFrame) -> DataFrame:
        found = attach_group_stats(df, self.by, self.table)
        return found.withColumn(self.output, F.coalesce(self.output, F.lit(self.mean)))


def evaluate(learner: Learner, train: DataFrame, test: DataFrame, target: str, guess: str = "prediction") -> DataFrame:
    """Fit on train, score on test: rows, mae, r2."""
    return regression_scores(learner.fit(train).transform(test), target, guess)


def cross_validate(learner, df: DataFrame, fold: str, folds: int, evaluator: Evaluator, parallelism: int = 4) -> tuple[float, float]:
    """Mean and population deviation of the score over given folds, several folds at a time."""
    fitted = search(learner, df, {}, fold, folds, evaluator, parallelism)
    return float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])


def search(
    learner, df: DataFrame, grid: Mapping, fold: str, folds: int, evaluator: Evaluator, parallelism: int = 4
) -> CrossValidatorModel:
    """Grid search over given folds, then a refit of the best setting on all rows."""
    maps = ParamGridBuilder()
    for param, values in grid.items():
        maps = maps.addGrid(param, list(values))
    return CrossValidator(
        estimator=learner, estimatorParamMaps=maps.build(), evaluator=evaluator, numFolds=folds, foldCol=fold,
        parallelism=parallelism, collectSubModels=False,
    ).fit(df)


def search_table(fitted: CrossValidatorModel, like: DataFrame) -> DataFrame:
    """One row per setting: its parameters, mean and deviation of the score."""
    rows = []
    for setting, mean, std in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics, fitted.stdMetrics, strict=True):
        named = ", ".join(f"{p.name}={v}" for p, v in sorted(setting.items(), key=lambda kv: kv[0].name))
        rows.append((named, float(mean), float(std)))
    return like.sparkSession.createDataFrame(rows, "setting string, mean double, std double")


def ladder(rows: Mapping[str, DataFrame]) -> DataFrame:
    """Scores of several models under one another, each row named."""
    out = None
    for i, (name, scores) in enumerate(rows.items()):
        row = scores.select(F.lit(i).alias("rank"), F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out


class Prepared:
    """A learner behind a preparation, both fitted on the same rows."""

    def __init__(self, preparation, learner: Learner):
        self.preparation, self.learner = preparation, learner

    def fit(self, df: DataFrame) -> Prepared:
        ready = self.preparation.fit(df)
        return Prepared(ready, self.learner.fit(ready.transform(df)))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.learner.transform(self.preparation.transform(df))
