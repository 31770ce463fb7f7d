"""Scores as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import cumulate


def regression_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Rows, mean absolute error and R squared."""
    gap = F.col(truth) - F.col(guess)
    return df.agg(
        F.count("*").alias("rows"),
        F.avg(F.abs(gap)).alias("mae"),
        (1.0 - F.try_divide(F.avg(gap * gap), F.var_pop(truth))).alias("r2"),
    )


def class_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support per label; 0 where a rate has no rows.

    Rows are counted per (truth, guess) first; what follows has one row per label pair.
    """
    cells = df.groupBy(F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count("*").alias("n"))
    sides = cells.select("n", F.explode(F.array_distinct(F.array("t", "g"))).alias("label"), "t", "g")
    counts = sides.groupBy("label").agg(
        F.sum(F.when((F.col("t") == F.col("label")) & (F.col("g") == F.col("label")), F.col("n")).otherwise(0)).alias("hit"),
        F.sum(F.when(F.col("g") == F.col("label"), F.col("n")).otherwise(0)).alias("guessed"),
        F.sum(F.when(F.col("t") == F.col("label"), F.col("n")).otherwise(0)).alias("support"),
    )

    def rate(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return counts.select(
        "label",
        rate(F.col("hit"), F.col("guessed")).alias("precision"),
        rate(F.col("hit"), F.col("support")).alias("recall"),
        rate(2 * F.col("hit"), F.col("guessed") + F.col("support")).alias("f1"),
        "support",
    )


def classification_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Rows, accuracy and the plain mean of the labels' F1."""
    report = class_report(df, truth, guess)
    return report.agg(
        F.sum("support").alias("rows"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
    )


def confusion(df: DataFrame, truth: str, guess: str, labels: Sequence) -> DataFrame:
    """Counts and row shares for every pair of the listed labels, empty cells included.

    Returns (truth_rank, guess_rank, truth, guess, n, share).
    """
    kind = df.schema[truth].dataType.simpleString()
    pairs = [(i, j, a, b) for i, a in enumerate(labels) for j, b in enumerate(labels)]
    grid = df.sparkSession.createDataFrame(pairs, f"truth_rank int, guess_rank int, truth {kind}, guess {kind}")
    cells = df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))
    full = grid.join(cells, ["truth", "guess"], "left").fillna(0, ["n"])
    whole = F.sum("n").over(Window.partitionBy("truth"))
    share = F.coalesce(F.try_divide("n", whole), F.lit(0.0)).alias("share")
    return full.select("truth_rank", "guess_rank", "truth", "guess", "n", share)


def _score_counts(df: DataFrame, label: str, score: str, buckets: int | None) -> DataFrame:
    positive = F.col(label) == 1
    return cumulate(df, score, {"pos": F.count_if(positive), "neg": F.count_if(~positive)}, buckets=buckets)


def roc_curve(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) when rows scoring at least the threshold are chosen."""
    c = _score_counts(df, label, score, buckets)
    return c.select(
        F.col(score).alias("threshold"),
        (1.0 - F.col("before_neg") / F.col("total_neg")).alias("fpr"),
        (1.0 - F.col("before_pos") / F.col("total_pos")).alias("tpr"),
    )


def auc(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Area under the curve: share of (positive, negative) pairs in order, ties counting half."""
    c = _score_counts(df, label, score, buckets)
    won = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0)
    return c.agg(F.try_divide(F.sum(won), F.max(F.col("total_pos") * F.col("total_neg"))).alias("auc"))


class MacroF1(Evaluator):
    """Mean of the labels' F1 for cross-validation (Spark's 'f1' weights labels by support)."""

    def __init__(self, label: str = "label", prediction: str = "prediction", metric: str = "macro_f1"):
        super().__init__()
        self.label, self.prediction, self.metric = label, prediction, metric

    def _evaluate(self, dataset: DataFrame) -> float:
        found = classification_scores(dataset, self.label, self.prediction).first()
        return float(found[self.metric])

    def isLargerBetter(self) -> bool:
        return True
