"""Spark ML learners set up to fit what the common array libraries fit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ensembles


def linear(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, solver="normal")


def ridge(df: DataFrame, label: str, alpha: float) -> LinearRegression:
    """Penalty alpha * |slopes|^2 on the sum of squares.

    Spark penalises the mean of squares of a target scaled by its deviation, so alpha is
    turned into alpha * std(target) / n; the normal solver uses the population deviation.
    """
    n, std = df.agg(F.count(label), F.stddev_pop(label)).first()
    return LinearRegression(
        labelCol=label, solver="normal", elasticNetParam=0.0, regParam=alpha * std / n, standardization=False
    )


def lasso(label: str, alpha: float) -> LinearRegression:
    """Penalty alpha * |slopes|_1 on half the mean of squares; feed it scaled features."""
    return LinearRegression(
        labelCol=label, elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=500, tol=1e-9
    )


def logistic(df: DataFrame, label: str, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """Binary or multinomial logistic regression with penalty 1/(2C) on the summed loss."""
    n = df.count()
    return LogisticRegression(labelCol=label, regParam=1.0 / (c * n), standardization=False, maxIter=max_iter)


def tree_regressor(label: str, depth: int | None = 5, **options) -> DecisionTreeRegressor:
    """A depth of None grows to Spark's limit of 30."""
    return DecisionTreeRegressor(labelCol=label, maxDepth=30 if depth is None else depth, seed=2026, **options)


def tree_classifier(label: str, depth: int | None = 5, **options) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, maxDepth=30 if depth is None else depth, seed=2026, **options)


def forest_regressor(
    label: str, trees: int = 100, max_features: float | str = "all", min_leaf: int = 1, depth: int = 15, seed: int = 2026, **options
) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, numTrees=trees, featureSubsetStrategy=str(max_features), minInstancesPerNode=min_leaf,
        maxDepth=depth, seed=seed, **options,
    )


class HistogramForestClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasSeed):
    """`ensembles.Forest` for a vector of features and labels 0, 1, .., with the parameters that Spark ML's forest has.

    A tree is grown by one task from its own rows, not a level of all trees per pass. A share of
    features is rounded down; rows without a label are left out.
    """

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of the deepest leaf", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf, at least", TypeConverters.toInt)
    featureSubsetStrategy = Param(
        Params._dummy(), "featureSubsetStrategy", "features tried per node: all, sqrt or a share", TypeConverters.toString
    )
    bootstrap = Param(Params._dummy(), "bootstrap", "whether each tree draws its rows", TypeConverters.toBoolean)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(
            featuresCol="features", labelCol="label", numTrees=20, maxDepth=5, maxBins=32, minInstancesPerNode=1,
            featureSubsetStrategy="sqrt", bootstrap=True, seed=2026,
        )
        self._set(**values)

    def _fit(self, df: DataFrame) -> HistogramForestModel:
        get, label = self.getOrDefault, self.getLabelCol()
        tried = get("featureSubsetStrategy")
        classes = int(df.agg(F.max(label)).first()[0] or 0) + 1
        forest = ensembles.Forest(
            label, vector=self.getFeaturesCol(), classes=classes, trees=get("numTrees"), max_depth=get("maxDepth"),
            min_leaf=get("minInstancesPerNode"), per_split={"sqrt": "sqrt", "all": None}[tried] if tried in ("sqrt", "all") else float(tried),
            bootstrap=get("bootstrap"), max_bins=get("maxBins"), seed=self.getSeed(),
        )
        return HistogramForestModel(forest.fit(df))


class HistogramForestModel(Model):
    """Adds prediction, and the class shares as the vector probability."""

    def __init__(self, forest: ensembles.FittedForest):
        super().__init__()
        self.forest = forest

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.forest.transform(df).withColumn("probability", array_to_vector("probability"))

    @property
    def featureImportances(self):  # noqa: N802  as Spark's own models name it
        return self.forest.featureImportances


def forest_classifier(
    label: str, trees: int = 300, max_features: float | str = "sqrt", min_leaf: int = 1, depth: int = 15, seed: int = 2026,
    by_level: bool = False, **options,
) -> HistogramForestClassifier | RandomForestClassifier:
    """A tree per task, or with `by_level` Spark ML's forest, which has fewer jobs per fit."""
    build = RandomForestClassifier if by_level else HistogramForestClassifier
    return build(
        labelCol=label, numTrees=trees, featureSubsetStrategy=str(max_features), minInstancesPerNode=min_leaf,
        maxDepth=depth, seed=seed, **options,
    )


def boosting_regressor(label: str, rounds: int = 100, rate: float = 0.1, depth: int = 5, **options) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=depth, seed=2026, **options)


def boosting_classifier(
    label: str, classes: int, rounds: int = 100, rate: float = 0.1, depth: int = 5, min_leaf: int = 20, **options
) -> GBTClassifier | OneVsRest:
    """Spark boosts two classes; more are handled one against the rest."""
    two = GBTClassifier(
        labelCol=label, maxIter=rounds, stepSize=rate, maxDepth=depth, minInstancesPerNode=min_leaf, seed=2026, **options
    )
    if classes == 2:
        return two
    # the inner learner meets the label that the outer one makes
    return OneVsRest(classifier=two, labelCol=label, parallelism=4)


def perceptron_curve(
    train: DataFrame, label: str, layers: Sequence[int], checkpoints: Sequence[int], seed: int = 2026
) -> list[tuple[int, object]]:
    """Feed-forward net at several iteration counts, each run starting from the last one's weights."""
    done, weights, out = 0, None, []
    for upto in checkpoints:
        net = MultilayerPerceptronClassifier(labelCol=label, layers=list(layers), maxIter=upto - done, seed=seed)
        if weights is not None:
            net = net.setInitialWeights(weights)
        model = net.fit(train)
        done, weights = upto, model.weights
        out.append((upto, model))
    return out
