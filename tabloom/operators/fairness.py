"""Group fairness audit and mitigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach_group_stats
from .ordered import covering, cumulate, exact_quantiles


def audit(df: DataFrame, group: str, truth: str, chosen: Column) -> DataFrame:
    """Selection rate, true and false positive rates and base rate per group.

    A group without positives (or negatives) gets a rate of 0.
    """
    picked = chosen.cast("double")
    y = F.col(truth)
    return df.groupBy(group).agg(
        F.count("*").alias("rows"),
        F.avg(picked).alias("selection_rate"),
        F.coalesce(F.avg(F.when(y == 1, picked)), F.lit(0.0)).alias("tpr"),
        F.coalesce(F.avg(F.when(y == 0, picked)), F.lit(0.0)).alias("fpr"),
        F.avg(y.cast("double")).alias("base_rate"),
    )


def base_rate_threshold(df: DataFrame, score: str, truth: str) -> DataFrame:
    """Score above which as many rows are chosen as there are positives (one row).

    The quantile at 1 - base rate, read from the counted distinct scores.
    """
    counted = cumulate(df, score)
    rate = df.agg(F.avg(F.col(truth).cast("double"))).scalar()
    place = (1.0 - rate) * (F.col("total_n") - 1)
    ends = counted.agg(
        covering(score, F.floor(place)).alias("lo"),
        covering(score, F.ceil(place)).alias("hi"),
        F.max(place - F.floor(place)).alias("part"),
    )
    return ends.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("threshold"))


def equal_opportunity(df: DataFrame, group: str, truth: str, score: str, target_tpr: float) -> DataFrame:
    """Per-group thresholds that bring each group to one true positive rate, then the audit."""
    positives = df.where(F.col(truth) == 1)
    cuts = exact_quantiles(positives, score, {"threshold": 1 - target_tpr}, [group]).drop("n")
    groups = df.select(group).distinct()
    stats = groups.join(cuts, groups[group].eqNullSafe(cuts[group]), "left").select(groups[group], "threshold")
    looked = attach_group_stats(df, [group], stats)
    # a group without positives has no threshold and selects nobody
    chosen = F.coalesce(F.col(score) >= F.col("threshold"), F.lit(False))
    report = audit(looked.withColumn("__c", chosen), group, truth, F.col("__c"))
    again = report.join(stats, report[group].eqNullSafe(stats[group]), "left")
    return again.select(report[group], "threshold", "rows", "selection_rate", "tpr", "fpr", "base_rate")
