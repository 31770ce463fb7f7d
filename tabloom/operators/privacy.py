"""Re-identification risk, anonymisation and differential privacy."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.hashing import laplace, open_uniform, uniform
from ..functions.scalars import floor_bin
from .inference import grouped_once
from .joins import attach_group_stats
from .sampling import resample


def reidentification_risk(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Percent of rows alone in their group, and the smallest group, per key set."""
    out, grouped = None, grouped_once(df, key_sets)
    for name, keys in key_sets.items():
        sizes = grouped.groupBy(*keys).agg(F.sum("__k").alias("k"))
        row = sizes.agg(
            F.lit(name).alias("key_set"),
            F.sum("k").alias("rows"),
            (100.0 * F.count_if(F.col("k") == 1) / F.sum("k")).alias("unique_percent"),
            F.min("k").alias("min_k"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def generalise(df: DataFrame, bins: Mapping[str, int] = {}, drop: Sequence[str] = ()) -> DataFrame:
    """Coarsen numbers to fixed-width bins and drop the finest columns."""
    return df.withColumns({c: floor_bin(c, w) for c, w in bins.items()}).drop(*drop)


def k_anonymity(df: DataFrame, keys: Sequence[str], k: int = 5) -> DataFrame:
    """Percent of rows in groups smaller than k, and the smallest group."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("k"))
    small = F.sum(F.when(F.col("k") < k, F.col("k")).otherwise(0))
    return sizes.agg(
        F.sum("k").alias("rows"), (100.0 * small / F.sum("k")).alias("below_k_percent"), F.min("k").alias("min_k")
    )


def suppress_small_groups(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Only the rows whose group has at least k rows: the release itself."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__k"))
    return attach_group_stats(df, keys, sizes).where(F.col("__k") >= k).drop("__k")


def l_diversity(df: DataFrame, keys: Sequence[str], sensitive: str, minimum: int = 2) -> DataFrame:
    """Percent of groups holding at least `minimum` sensitive values."""
    groups = df.groupBy(*keys).agg(F.count_distinct(sensitive).alias("d"))
    return groups.agg(
        F.count("*").alias("groups"),
        (100.0 * F.avg((F.col("d") >= minimum).cast("double"))).alias("diverse_percent"),
        F.min("d").alias("min_distinct"),
    )


def secure_uniform(column: Column) -> Column:
    """Uniform on (0,1) from the operating system's secure source, one draw per row."""

    # defined here, so that it travels to the executors by value
    def draw(ids: pd.Series) -> pd.Series:
        import secrets

        return pd.Series([(secrets.randbits(53) + 0.5) / 2.0**53 for _ in range(len(ids))])

    return F.pandas_udf(draw, DoubleType()).asNondeterministic()(column.cast("double"))


def noisy_counts(
    df: DataFrame,
    by: Sequence[str],
    amount: Column,
    epsilon: float,
    sensitivity: float = 1.0,
    test_salt: str | None = None,
) -> DataFrame:
    """Group totals with Laplace noise of scale sensitivity/epsilon: (by, true, noisy).

    Noise comes from the operating system's secure source, one draw per group. A salt
    makes it repeatable for tests; such noise must never be published. Drop `true` and
    fix the list of groups beforehand in a real release.
    """
    totals = df.groupBy(*by).agg(F.sum(amount).alias("true"))
    if test_salt is None:
        u = secure_uniform(F.col("true"))
    else:
        u = open_uniform(list(by), test_salt)
    return totals.withColumn("noisy", F.col("true") + laplace(u, sensitivity / epsilon))


def geometric_counts(df: DataFrame, by: Sequence[str], epsilon: float, test_salt: str | None = None) -> DataFrame:
    """Group counts with two-sided geometric noise: whole numbers, so no low bits leak."""
    totals = df.groupBy(*by).agg(F.count("*").alias("true"))
    alpha = math.exp(-epsilon)

    def draw(part: str) -> Column:
        if test_salt is not None:
            u = open_uniform(list(by), test_salt + part)
        else:
            u = secure_uniform(F.col("true") + len(part))
        return F.floor(F.log(u) / F.lit(math.log(alpha)))

    return totals.withColumn("noisy", F.col("true") + draw("a") - draw("bb"))


def noise_error_curve(
    df: DataFrame, by: Sequence[str], epsilons: Sequence[float], repeats: int, salt: str, sensitivity: float = 1.0
) -> DataFrame:
    """What noise does to a table's group counts: for each epsilon, over repeats of the release,
    the mean absolute and the mean relative error of the published counts (rounded, not below 0)."""
    groups = df.groupBy(*by).agg(F.count("*").alias("true"))
    grid = F.explode(F.array(*[F.lit(float(e)) for e in epsilons])).alias("epsilon")
    draws = groups.select(*by, "true", grid).select(
        *by, "true", "epsilon", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")
    )
    u = open_uniform([*by, "epsilon", "repeat"], salt)
    noise = laplace(u, 1.0) * F.lit(float(sensitivity)) / F.col("epsilon")
    published = F.greatest(F.round(F.col("true") + noise), F.lit(0.0))
    error = F.abs(published - F.col("true"))
    return draws.groupBy("epsilon").agg(
        F.count("*").alias("draws"), F.avg(error).alias("mean_abs_error"), F.avg(error / F.col("true")).alias("mean_rel_error")
    )


def randomised_response(df: DataFrame, key, truth: Column, salt: str) -> DataFrame:
    """Two-coin randomised answers and the unbiased estimate of the true rate.

    The first coin decides whether to answer truthfully, else the second answers.
    """
    honest = uniform(key, salt + "-1") < 0.5
    answer = F.when(honest, truth.cast("double")).otherwise((uniform(key, salt + "-2") < 0.5).cast("double"))
    rates = df.agg(
        F.count("*").alias("rows"), F.avg(truth.cast("double")).alias("true_rate"), F.avg(answer).alias("observed_rate")
    )
    return rates.select(
        "*",
        (2.0 * F.col("observed_rate") - 0.5).alias("estimate"),
        F.lit(math.log(3.0)).alias("epsilon"),
    )


def synthesise_independent(df: DataFrame, key, groups: Sequence[Sequence[str]], salt: str) -> DataFrame:
    """Table of the same size whose column groups are resampled each on their own.

    Columns of one group stay together; between groups every relation is lost.
    """
    out = None
    for i, columns in enumerate(groups):
        drawn = resample(df, key, columns, f"{salt}-{i}")
        out = drawn if out is None else out.join(drawn, "draw")
    return out
