"""The tables behind distribution charts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach_group_stats
from .ordered import cumulate, quantiles


def histogram(df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """Equal-width bins, the last one closed: (bin, low, high, n, density). Empty bins are kept."""
    v = F.col(value).cast("double")
    if low is None or high is None:
        found = df.agg(F.min(v), F.max(v)).first()
        low, high = (found[0] if low is None else low), (found[1] if high is None else high)
    if low is None or high is None:
        raise ValueError("no values to bin")
    low, high = float(low), float(high)
    if low == high:
        low, high = low - 0.5, high + 0.5  # one value: a unit range around it
    width = (high - low) / bins
    number = F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where((v >= low) & (v <= high)).groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = every.join(counts, "bin", "left").fillna(0, ["n"])
    total = F.sum("n").over(Window.partitionBy())  # over the bins
    return full.select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
        "n",
        F.try_divide(F.col("n"), total * width).alias("density"),
    )


def density_curve(df: DataFrame, value: str, points: int = 200, per_bandwidth: int | None = None) -> DataFrame:
    """Gaussian density on an even grid, Scott bandwidth: (point, x, density).

    Exact over the counted distinct values. With `per_bandwidth` (10, say) rows are first counted in
    bins that many times narrower than the bandwidth, so the grid meets bins and not values: close
    to exact, and cheap however many values there are.
    """
    v = F.col(value).cast("double")
    n, s, low, high = df.agg(F.count(v), F.stddev_samp(v), F.min(v), F.max(v)).first()
    if n < 2 or not s:
        raise ValueError("a density needs at least two different values")
    h = s * n**-0.2
    if per_bandwidth is None:
        centre = v
    else:
        width = h / per_bandwidth
        centre = (F.floor((v - low) / width) + 0.5) * width + low
    binned = df.where(v.isNotNull()).groupBy(centre.alias("c")).agg(F.count("*").alias("m"))
    step = (high - low) / (points - 1)
    spread = binned.select("c", "m", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.lit(low) + F.col("point") * step
    z = (x - F.col("c")) / h
    kernel = F.col("m") * F.exp(-0.5 * z * z)
    summed = spread.select("point", x.alias("x"), kernel.alias("k")).groupBy("point").agg(
        F.max("x").alias("x"), F.sum("k").alias("k")
    )
    return summed.select("point", "x", (F.col("k") / (n * h * math.sqrt(2 * math.pi))).alias("density"))


def ecdf(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows at or below each distinct value: (by, value, share)."""
    counted = cumulate(df, value, by=by)
    share = (F.col("before_n") + F.col("n")) / F.col("total_n")
    return counted.select(*by, value, "n", share.alias("share"))


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_summary(df: DataFrame, value: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (the last values inside the fences) and outlier count.

    Worked from the counted distinct values, which are reduced to one row per group.
    """
    q = quantiles(df, value, QUARTILES, by)
    reach = whisker * (F.col("q3") - F.col("q1"))
    q = q.withColumn("low_fence", F.col("q1") - reach).withColumn("high_fence", F.col("q3") + reach)
    return _inside_fences(df, value, q, by)


def _inside_fences(df: DataFrame, value: str, q: DataFrame, by: Sequence[str]) -> DataFrame:
    v = F.col(value).cast("double")
    if by:
        # counted per value and spread over the group's values: no task holds a big group
        rows = df.where(v.isNotNull()).groupBy(*by, v.alias("__v")).agg(F.count("*").alias("__m"))
        fenced = attach_group_stats(rows, by, q)
    else:
        limits = q.first()  # one row of limits
        if limits is None:
            raise ValueError("no values to summarise")
        limits = limits.asDict()
        rows = df.where(v.isNotNull()).select(v.alias("__v"), F.lit(1).alias("__m"))
        fenced = rows.select("*", *[F.lit(x).alias(c) for c, x in limits.items()])
    ok = (F.col("__v") >= F.col("low_fence")) & (F.col("__v") <= F.col("high_fence"))
    keep = ["n", *QUARTILES, "low_fence", "high_fence"]
    return fenced.groupBy(*by).agg(
        *[F.max(c).alias(c) for c in keep],
        F.min(F.when(ok, F.col("__v"))).alias("low_whisker"),
        F.max(F.when(ok, F.col("__v"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~ok, F.col("__m"))), F.lit(0)).alias("outliers"),
    )


# Fixed value: where Tukey's upper fence lies on a standard normal, in deviations.
TUKEY_FENCE_SIGMAS = 2.6979592


def outlier_flags(df: DataFrame, value: str, whisker: float = 1.5, sigmas: float = 3.0) -> DataFrame:
    """Each row with flags: outside the quartile fences, beyond k deviations."""
    q = quantiles(df, value, QUARTILES).first()  # one row of limits
    if q is None:  # no values, so none is outside
        none = F.lit(None).cast("boolean")
        return df.withColumn("outside_fences", none).withColumn("beyond_sigmas", none)
    mean, std = df.agg(F.avg(value), F.stddev_samp(value)).first()
    reach = whisker * (q["q3"] - q["q1"])
    v = F.col(value)
    fenced = (v < q["q1"] - reach) | (v > q["q3"] + reach)
    return df.withColumn("outside_fences", fenced).withColumn("beyond_sigmas", F.abs(v - mean) > sigmas * std)


def hexbin(df: DataFrame, x: str, y: str, grid: int = 28) -> DataFrame:
    """Counts per hexagonal cell (lattice, i, j, n); empty cells are absent.

    Two rectangular lattices offset by half a cell; a point belongs to the nearer centre.
    """
    rows_y = int(grid / 3**0.5)
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    x0, x1, y0, y1 = both.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    pts = both.select(x, y)
    ix = (F.col(x) - x0) / F.lit(float(x1 - x0)) * F.lit(float(grid))
    iy = (F.col(y) - y0) / F.lit(float(y1 - y0)) * F.lit(float(rows_y))
    scaled = pts.select(ix.alias("ix"), iy.alias("iy"))
    near = scaled.select(
        "ix",
        "iy",
        F.floor(F.col("ix") + 0.5).alias("i1"),
        F.floor(F.col("iy") + 0.5).alias("j1"),
        F.floor("ix").alias("i2"),
        F.floor("iy").alias("j2"),
    )
    d1 = F.pow(F.col("ix") - F.col("i1"), 2) + 3.0 * F.pow(F.col("iy") - F.col("j1"), 2)
    d2 = F.pow(F.col("ix") - F.col("i2") - 0.5, 2) + 3.0 * F.pow(F.col("iy") - F.col("j2") - 0.5, 2)
    first = d1 < d2
    cells = near.select(
        F.when(first, 1).otherwise(2).alias("lattice"),
        F.when(first, F.col("i1")).otherwise(F.col("i2")).alias("i"),
        F.when(first, F.col("j1")).otherwise(F.col("j2")).alias("j"),
    )
    return cells.groupBy("lattice", "i", "j").agg(F.count("*").alias("n"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise Pearson correlations in one pass, long form (a, b, r), both orders."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for p, q in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(p).alias("a"), F.lit(q).alias("b"), F.col(f"r{i}").alias("r")))
    return wide.select(F.inline(F.array(*cells)))


def correlation_with(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with a target, one pass: (feature, n, r)."""
    wide = df.agg(
        *[F.corr(f, target).alias(f"r{i}") for i, f in enumerate(features)],
        *[F.count_if(F.col(f).isNotNull() & F.col(target).isNotNull()).alias(f"n{i}") for i, f in enumerate(features)],
    )
    cells = [
        F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("r"))
        for i, f in enumerate(features)
    ]
    return wide.select(F.inline(F.array(*cells)))


def line_by_group(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Means, deviations, correlation and least-squares line of y on x, per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(x).alias("x_mean"),
        F.avg(y).alias("y_mean"),
        F.stddev_samp(x).alias("x_std"),
        F.stddev_samp(y).alias("y_std"),
        F.corr(x, y).alias("r"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )


def profile_by_level(df: DataFrame, level: str | Column, value: str) -> DataFrame:
    """Mean of a value per level of an ordered variable."""
    column = F.col(level) if isinstance(level, str) else level
    return df.groupBy(column.alias("level")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))


