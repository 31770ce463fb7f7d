"""Stored sketches: a slice of a table is read once, and answers for any union of slices come from its sketches.

A sketch table has one row per slice (a day, a file): rows, and for each number column a KLL sketch
for quantiles and ranks, for each key an HLL sketch (distinct values) and a theta sketch, which also
knows unions and differences. Sketches have a fixed size whatever the slice holds. The exact
routes (`quantiles`, distinct counts, unmatched keys) stay the default elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K, HLL_LG_K, THETA_LG_K = 400, 14, 14


def rank_error(k: int = KLL_K) -> float:
    """How far the rank of a KLL quantile may lie off, as a part of all rows, in 99 of 100 cases."""
    return 2.296 / k**0.9723  # fixed values: the published bound of this sketch


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    """Relative error of an HLL count in 99 of 100 cases: 2.6 standard errors of a merged sketch."""
    return 2.6 * 1.04 / 2 ** (lg_k / 2)


def theta_error(lg_k: int = THETA_LG_K) -> float:
    """Error of a theta count in 99 of 100 cases, as a part of the union that it was estimated from."""
    return 2.6 / 2 ** (lg_k / 2)


def key_value(columns: Sequence[str]) -> Column:
    """One text for a key of several columns; missing if one of them is. Lengths keep the parts apart."""
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])


def sketch_table(df: DataFrame, by: Sequence[str], numbers: Sequence[str] = (), keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per slice: by, rows, kll_<number>, hll_<key>, theta_<key>. Missing values aren't sketched (NaN neither).

    Tasks fill sketches of their own, so a slice with most of the rows is no hot group.
    """
    cells = [F.count(F.lit(1)).alias("rows")]
    for c in numbers:
        value = F.col(c).cast("double")
        cells.append(F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(KLL_K)).alias(f"kll_{c}"))
    for name, columns in (keys or {}).items():
        cells.append(F.hll_sketch_agg(key_value(columns), F.lit(HLL_LG_K)).alias(f"hll_{name}"))
        cells.append(F.theta_sketch_agg(key_value(columns), F.lit(THETA_LG_K)).alias(f"theta_{name}"))
    return df.groupBy(*by).agg(*cells)


def merged_quantiles(sketches: DataFrame, number: str, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, one column per prob) from the sketches of all slices of a group; groups without values have none."""
    held = sketches.groupBy(*by).agg(F.kll_merge_agg_double(f"kll_{number}", F.lit(KLL_K)).alias("s"))
    n = F.kll_sketch_get_n_double("s")
    some = n > 0
    found = [F.when(some, F.kll_sketch_get_quantile_double("s", F.lit(float(p)))).alias(name) for name, p in probs.items()]
    return held.select(*by, n.alias("n"), *found)


def merged_rank(sketches: DataFrame, number: str, value: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, rank): the part of the rows that lie at or below a value."""
    held = sketches.groupBy(*by).agg(F.kll_merge_agg_double(f"kll_{number}", F.lit(KLL_K)).alias("s"))
    some = F.kll_sketch_get_n_double("s") > 0
    return held.select(*by, F.when(some, F.kll_sketch_get_rank_double("s", F.lit(float(value)))).alias("rank"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, one column per key): estimated distinct values over all slices of a group."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"hll_{k}")).alias(k) for k in keys])


def _union(sketches: DataFrame, key: str) -> DataFrame:
    return sketches.agg(F.theta_union_agg(f"theta_{key}", F.lit(THETA_LG_K)).alias("s"))


def unmatched_keys(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """(left_keys, unmatched): distinct keys of the left slices, and those the right ones don't have, estimated."""
    one, two = _union(left, key), _union(right, right_key or key).withColumnRenamed("s", "t")
    both = one.join(F.broadcast(two))  # one sketch each
    apart = F.theta_sketch_estimate(F.theta_difference("s", "t"))
    return both.select(F.theta_sketch_estimate("s").alias("left_keys"), apart.alias("unmatched"))
