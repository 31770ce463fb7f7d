"""Preprocessing stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, PolynomialExpansion, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PopulationScaler(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Subtract the mean and divide by the population deviation of the fitted rows.

    A constant column is only centred. (Spark's own scaler uses the sample deviation.)
    The fitted stage is a SELECT, so scoring stays in generated code.
    """

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        names = self.getInputCols()
        facts = dataset.agg(
            *[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]
        ).first()
        means, stds = facts[: len(names)], facts[len(names):]
        if any(m is None for m in means):
            raise ValueError("can't fit a scaler on an empty column")
        made = [
            f"(`{c}` - ({float(m)!r}D)) / ({float(s) or 1.0!r}D) AS `{out}`"
            for c, m, s, out in zip(names, means, stds, self.getOutputCols(), strict=True)
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")


def scale_numbers(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with the columns scaled by what the train table alone shows."""
    model = PopulationScaler(inputCols=list(columns), outputCols=[f"z_{c}" for c in columns]).fit(train)
    return model.transform(train), model.transform(test)


def columns_to_features(
    numbers: Sequence[str] = (),
    categories: Sequence[str] = (),
    scaled: bool = True,
    one_hot: bool = True,
    output: str = "features",
    keep_invalid: str = "error",
) -> Pipeline:
    """Scale numbers and code categories into one vector column.

    A category unseen in training codes to all zeros: the spare index that 'keep' adds is
    the one the encoder drops, so no known category is lost. With `one_hot=False` the
    category number itself goes in, and tree learners split by category.
    """
    stages, parts = [], []
    if numbers:
        if scaled:
            made = [f"z_{c}" for c in numbers]
            stages.append(PopulationScaler(inputCols=list(numbers), outputCols=made))
        parts += made if scaled else list(numbers)
    if categories:
        index = [f"i_{c}" for c in categories]
        stages.append(StringIndexer(inputCols=list(categories), outputCols=index, handleInvalid="keep"))
        if one_hot:
            coded = [f"o_{c}" for c in categories]
            stages.append(OneHotEncoder(inputCols=index, outputCols=coded, dropLast=True))
            parts += coded
        else:
            parts += index
    stages.append(VectorAssembler(inputCols=parts, outputCol=output, handleInvalid=keep_invalid))
    return Pipeline(stages=stages)


def polynomial(numbers: Sequence[str], degree: int, output: str = "features") -> Pipeline:
    """All products of the scaled columns up to a degree (the learner adds the constant)."""
    made = [f"z_{c}" for c in numbers]
    return Pipeline(
        stages=[
            PopulationScaler(inputCols=list(numbers), outputCols=made),
            VectorAssembler(inputCols=made, outputCol="__plain"),
            PolynomialExpansion(degree=degree, inputCol="__plain", outputCol=output),
        ]
    )


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's entries, from the column's metadata."""
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    found = sorted((a["idx"], a["name"]) for kind in attrs.values() for a in kind)
    return [name for _, name in found]
