"""Estimates and tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import exact_smirnov, smirnov, t_two_sided
from ..session import ship_package, written
from .distributions import correlation_with
from .joins import attach_group_stats
from .ordered import cumulate, cut_points, exact_quantiles, put_in_buckets, quantiles_of_counted

Z95 = 1.96  # fixed value: the two-sided 95 % point used by the interval


def skewness_of_batch_means(df: DataFrame, value: str, batch: Column) -> DataFrame:
    """Population skewness of the means of batches of rows."""
    means = df.groupBy(batch.alias("__batch")).agg(F.avg(value).alias("m"))
    return means.agg(F.count("*").alias("batches"), F.skewness("m").alias("skewness"))


def mean_interval(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """95 % interval of the mean from the normal approximation."""
    facts = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("s")
    )
    half = Z95 * F.col("s") / F.sqrt("n")
    return facts.select(*by, "n", "mean", (F.col("mean") - half).alias("low"), (F.col("mean") + half).alias("high"))


def _arm(condition: Column, value: str) -> list[Column]:
    v = F.when(condition, F.col(value))
    return [F.count(v), F.avg(v), F.var_samp(v)]


def welch(df: DataFrame, value: str, first: Column, second: Column, by: Sequence[str] = ()) -> DataFrame:
    """Unequal-variance t-test and Cohen's d of two arms (of each group), from one pass over the rows.

    A group with fewer than two values in an arm, or the same value throughout an arm, has no p.
    """
    names = ["n1", "mean1", "var1", "n2", "mean2", "var2"]
    facts = df.groupBy(*by).agg(
        *[c.alias(n) for c, n in zip(_arm(first, value) + _arm(second, value), names, strict=True)]
    )
    if by:
        facts = facts.where("var1 > 0 and var2 > 0")
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    v1, v2 = F.col("var1"), F.col("var2")
    a, b = v1 / n1, v2 / n2
    gap = F.col("mean1") - F.col("mean2")
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    tested = facts.select(
        *by,
        "n1",
        "n2",
        "mean1",
        "mean2",
        (gap / F.sqrt(a + b)).alias("t"),
        ((a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1))).alias("df"),
        (gap / F.sqrt(pooled)).alias("cohen_d"),
    )
    return tested.withColumn("p", t_two_sided(F.col("t"), F.col("df")))


def adjust_p(
    df: DataFrame, test: str, p: str, alpha: float = 0.05, buckets: int | None = None
) -> DataFrame:
    """Benjamini-Hochberg adjusted p and the Bonferroni verdict for a table of tests.

    Works on distinct p-values: adj(p) = min over q >= p of q * m / #(p <= q), whose
    running minimum is taken inside buckets plus the minimum of the buckets after.
    """
    cuts = cut_points(df.select(p), p, buckets)
    counted = cumulate(df.select(test, p), p, cuts=cuts)
    raw = counted.select(
        p, "n", F.col("total_n").alias("m"),
        (F.col(p) * F.col("total_n") / (F.col("before_n") + F.col("n"))).alias("raw"),
    )
    placed = put_in_buckets(raw, p, cuts, "__b")
    later_in = Window.partitionBy("__b").orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0)
    least = placed.groupBy("__b").agg(F.min("raw").alias("low"))
    after = Window.partitionBy().orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    bounds = F.broadcast(least.select("__b", F.min("low").over(after).alias("low_after")))
    table = placed.withColumn("low_in", F.min("raw").over(later_in)).join(bounds, "__b")
    adjusted = F.least(F.lit(1.0), F.col("low_in"), F.col("low_after"))
    table = table.select(p, "n", "m", adjusted.alias("p_adjusted"))
    out = attach_group_stats(df.select(test, p), [p], table)
    return out.select(
        test,
        p,
        "p_adjusted",
        (F.col("p_adjusted") < alpha).alias("bh_significant"),
        (F.col(p) < F.lit(alpha) / F.col("m")).alias("bonferroni_significant"),
    )


def screen_features(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.05) -> DataFrame:
    """Correlation of every feature with a target, its p-value, and both corrections."""
    r = F.col("r")
    t = r * F.sqrt((F.col("n") - 2) / (1.0 - r * r))
    tested = correlation_with(df, features, target).withColumn("p", t_two_sided(t, (F.col("n") - 2).cast("double")))
    return tested.join(adjust_p(tested, "feature", "p", alpha).drop("p"), "feature")


def ks_two_sample(
    df: DataFrame, value: str, first: Column, second: Column, by: Sequence[str] = (), exact_rows: int = 10_000
) -> DataFrame:
    """Largest distance between two empirical distributions, with its p.

    The p is exact where neither sample has more than `exact_rows` rows (0: nowhere), else asymptotic.
    The exact law is that of samples without ties, as usual.
    """
    counted = cumulate(
        df.where(first | second),
        value,
        {"n1": F.count_if(first), "n2": F.count_if(second)},
        by,
    )
    # a group without rows on one side has no distance
    f1 = F.try_divide(F.col("before_n1") + F.col("n1"), F.col("total_n1"))
    f2 = F.try_divide(F.col("before_n2") + F.col("n2"), F.col("total_n2"))
    d = counted.groupBy(*by).agg(
        F.max("total_n1").alias("n1"), F.max("total_n2").alias("n2"), F.max(F.abs(f1 - f2)).alias("ks")
    )
    far, n1, n2 = F.col("ks"), *[F.when(F.col(n) > 0, F.col(n)).cast("double") for n in ("n1", "n2")]
    p = smirnov(far, n1, n2)
    if exact_rows:
        ship_package(df.sparkSession)
        small = F.greatest("n1", "n2") <= exact_rows
        # a test that isn't small is handed over empty, so that no time goes into it
        p = F.when(small, exact_smirnov(F.when(small, far), n1, n2)).otherwise(p)
    return d.withColumn("p", p)


FLOOR = 1e-6  # fixed value: least share of a bin, and how far the end bins are widened


def base_edges(df: DataFrame, value: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Array of bin edges (by, edges): quantiles of the base, the ends widened."""
    q = exact_quantiles(df, value, {f"e{i}": i / bins for i in range(bins + 1)}, by)
    ends = [F.col(f"e{i}") for i in range(bins + 1)]
    ends[0], ends[-1] = ends[0] - FLOOR, ends[-1] + FLOOR
    return q.select(*by, F.array(*ends).alias("edges"))


def bin_number(value: Column, edges: Sequence[Column], bins: int) -> Column:
    """0-based bin, the last edge <= value; NULL outside. Equal edges leave a bin empty."""
    number = F.lit(-1)
    for edge in edges[:bins]:
        number = number + (value >= edge).cast("int")
    return F.when((value >= edges[0]) & (value <= edges[bins]), number)


def psi_from_counts(counts: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Stability index from (by, bin, base, new); rows without a bin stay in the totals."""
    total = F.lit(0.0)
    for i in range(bins):
        here = F.col("bin") == i
        b = F.coalesce(F.sum(F.when(here, F.col("base"))), F.lit(0)) / F.sum("base")
        n = F.coalesce(F.sum(F.when(here, F.col("new"))), F.lit(0)) / F.sum("new")
        b, n = F.greatest(b, F.lit(FLOOR)), F.greatest(n, F.lit(FLOOR))
        total = total + (n - b) * F.log(n / b)
    return counts.groupBy(*by).agg(F.sum("base").alias("n_base"), F.sum("new").alias("n_new"), total.alias("psi"))


def stability_index(df: DataFrame, value: str, base: Column, new: Column, bins: int = 10) -> DataFrame:
    """Population stability index of a new segment against a base segment."""
    found = base_edges(df.where(base), value, bins).first()  # bins + 1 numbers
    if found is None:
        raise ValueError("the base segment is empty")
    edges = found[0]
    number = bin_number(F.col(value), [F.lit(e) for e in edges], bins)
    counts = (
        df.where(base | new)
        .groupBy(number.alias("bin"))
        .agg(F.count_if(base).alias("base"), F.count_if(new).alias("new"))
    )
    return psi_from_counts(counts, bins)


def drift_report(df: DataFrame, columns: Sequence[str], base: Column, new: Column, bins: int = 10) -> DataFrame:
    """Means, KS and stability index of two segments, one row per column.

    The columns are stacked into one long table, and each column's distinct values are counted and
    ranked once for both segments: means, KS distance, bin edges and bin counts all come from that.
    """
    kind = F.when(base, "base").when(new, "new")
    long = df.select(kind.alias("__kind"), *[F.col(c).cast("double").alias(c) for c in columns])
    long = long.where("__kind is not null").unpivot("__kind", list(columns), "column_name", "__x")
    is_base = F.col("__kind") == "base"
    counts = {"n1": F.count_if(is_base), "n2": F.count_if(~is_base)}
    counted = written(cumulate(long, "__x", counts, ["column_name"]), "counted")
    f1 = (F.col("before_n1") + F.col("n1")) / F.col("total_n1")
    f2 = (F.col("before_n2") + F.col("n2")) / F.col("total_n2")
    facts = counted.groupBy("column_name").agg(
        (F.sum(F.col("__x") * F.col("n1")) / F.sum("n1")).alias("base_mean"),
        (F.sum(F.col("__x") * F.col("n2")) / F.sum("n2")).alias("new_mean"),
        F.max(F.abs(f1 - f2)).alias("ks"),
        F.max("total_n1").cast("double").alias("n1"),
        F.max("total_n2").cast("double").alias("n2"),
    )
    facts = facts.withColumn("p", smirnov(F.col("ks"), F.col("n1"), F.col("n2"))).drop("n1", "n2")
    probs = {f"e{i}": i / bins for i in range(bins + 1)}
    edges = quantiles_of_counted(counted.where("n1 > 0"), "__x", probs, ["column_name"], "n1").collect()  # a row per column
    number = None
    for row in edges:
        ends = [row[e] for e in probs]
        ends = [ends[0] - FLOOR, *ends[1:-1], ends[-1] + FLOOR]
        here = F.col("column_name") == row["column_name"]
        placed = bin_number(F.col("__x"), [F.lit(e) for e in ends], bins)
        number = F.when(here, placed) if number is None else number.when(here, placed)
    number = F.lit(None).cast("int") if number is None else number
    binned = counted.groupBy("column_name", number.alias("bin")).agg(F.sum("n1").alias("base"), F.sum("n2").alias("new"))
    psi = psi_from_counts(binned, bins, ["column_name"]).select("column_name", "psi")
    return facts.join(psi, "column_name")


def tail_share(df: DataFrame, condition: Column, expected: float) -> DataFrame:
    """Observed share of a condition next to the share a theory expects."""
    return df.agg(
        F.count("*").alias("rows"),
        F.avg(condition.cast("double")).alias("observed"),
        F.lit(float(expected)).alias("expected"),
    )


def entropy_bits(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shannon entropy of a key combination in bits, percent of unique rows, and the ceiling."""
    return _entropy(df.groupBy(*keys).agg(F.count("*").alias("k")))


def _entropy(sizes: DataFrame) -> DataFrame:
    # H = log2 N - sum(k log2 k) / N, so group sizes are all that is needed
    summed = sizes.agg(
        F.sum("k").alias("n"),
        F.sum(F.col("k") * F.log2(F.col("k").cast("double"))).alias("klogk"),
        F.count_if(F.col("k") == 1).alias("singles"),
        F.min("k").alias("min_k"),
    )
    ceiling = F.log2(F.col("n").cast("double"))
    return summed.select(
        "n",
        (ceiling - F.col("klogk") / F.col("n")).alias("entropy_bits"),
        (100.0 * F.col("singles") / F.col("n")).alias("unique_percent"),
        "min_k",
        ceiling.alias("ceiling_bits"),
    )


def grouped_once(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Group sizes by the union of all key sets, written: smaller key sets are grouped from it.

    The table is read once, and the finest grouping is what the others share.
    """
    every = list(dict.fromkeys(k for keys in key_sets.values() for k in keys))
    return written(df.groupBy(*every).agg(F.count("*").alias("__k")), "sizes")


def entropy_ladder(df: DataFrame, ladder: Mapping[str, Sequence[str]]) -> DataFrame:
    """Entropy of key sets of growing detail, one row per set."""
    out, sizes = None, grouped_once(df, ladder)
    for i, (name, keys) in enumerate(ladder.items()):
        row = _entropy(sizes.groupBy(*keys).agg(F.sum("__k").alias("k")))
        row = row.select(F.lit(i).alias("step"), F.lit(name).alias("key_set"), "*")
        out = row if out is None else out.unionByName(row)
    return out
