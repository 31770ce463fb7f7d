"""Samples, splits and shuffles in the order of hashed keys.

The hash order of a group is spread evenly, so its first hex digits are ready-made
buckets: ranks and cut-offs come from counts per bucket, and no task sorts a whole group.
`key` must name a row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import digest, uniform
from ..session import written
from .joins import attach_group_stats, join_null_safe


def digits_for(rows: int, per_bucket: int = 1 << 18) -> int:
    """Hex digits that leave at most about `per_bucket` rows in a bucket of a group of known size."""
    return max(1, math.ceil(math.log(max(rows / per_bucket, 1.0), 16)))


def _hashed(df: DataFrame, key, salt, digits: int) -> DataFrame:
    hashed = df.withColumn("__h", digest(key, salt))
    return hashed.withColumn("__p", F.substr("__h", F.lit(1), F.lit(digits)))


def _bucket_offsets(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    counts = hashed.groupBy(*by, "__p").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*by).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *by,
        "__p",
        "__n",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*by)).alias("__total"),
    )


def _chosen_digits(df: DataFrame, digits: int | None) -> int:
    """Digits for the table's size, unless they are given."""
    return digits_for(df.count()) if digits is None else digits


def rank_by_hash(
    df: DataFrame, key, salt, name: str = "rank", by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Every row's 1-based place in the hash order of its group: a reproducible shuffle."""
    by = list(by)
    hashed = _hashed(df, key, salt, _chosen_digits(df, digits))
    # one struct key for (group, bucket), so that window and join share one partitioning
    cell = F.struct(*by, "__p")
    offsets = _bucket_offsets(hashed, by).select(cell.alias("__cell"), "__before")
    inside = Window.partitionBy("__cell").orderBy("__h")
    ranked = hashed.withColumn("__cell", cell).withColumn("__in", F.row_number().over(inside))
    joined = ranked.join(offsets, "__cell")
    return joined.select(*df.columns, (F.col("__in") + F.col("__before")).alias(name))


def hash_cutoffs(
    df: DataFrame,
    key,
    salt,
    size: Column,
    sizes: DataFrame | None = None,
    by: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Per group (by, cutoff, rows): the digest at which exactly `size` rows lie at or below it.

    `size` may use columns of `sizes` (one row per group). Only the one bucket that
    holds the cut-off is ranked, a small part of the group. Groups of size 0 have no row.
    """
    by = list(by)
    hashed = _hashed(df, key, salt, _chosen_digits(df, digits)).select(*by, "__h", "__p")
    counted = _bucket_offsets(hashed, by)
    if sizes is not None:
        counted = join_null_safe(counted, sizes, by)
    wanted = F.least(size.cast("long"), F.col("__total"))
    edge = counted.where((F.col("__before") < wanted) & (wanted <= F.col("__before") + F.col("__n")))
    edge = edge.select(*by, "__p", (wanted - F.col("__before")).alias("__take"), "__total")
    # one row per group, written so that Spark knows its size: if it is small only the edge buckets' rows are shuffled
    edge = written(edge, "edges") if by else F.broadcast(edge)
    rows = join_null_safe(hashed, edge, [*by, "__p"])
    place = F.row_number().over(Window.partitionBy(*by).orderBy("__h"))
    cut = rows.withColumn("__r", place).where("__r = __take")
    return cut.select(*by, F.col("__h").alias("cutoff"), F.col("__total").alias("rows"))


def sample_exact(df: DataFrame, key, n: int, salt: str, digits: int | None = None) -> DataFrame:
    """Exactly n rows without replacement (all of them if there are fewer)."""
    cutoff = hash_cutoffs(df, key, salt, F.lit(n), digits=digits).select("cutoff")
    return df.where(digest(key, salt) <= cutoff.scalar())


def sample_per_group(
    df: DataFrame, key, n: int, salt: str, by: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Exactly n rows of each group (all rows of a smaller group): a cut-off per group makes it a filter."""
    by = list(by)
    cuts = hash_cutoffs(df, key, salt, F.lit(n), by=by, digits=digits)
    marked = attach_group_stats(df, by, cuts.select(*by, F.col("cutoff").alias("__cutoff")))
    return marked.where(digest(key, salt) <= F.col("__cutoff")).drop("__cutoff")


def sample_share(df: DataFrame, key, share: float, salt: str) -> DataFrame:
    """Rows whose uniform lies below the share: stable when rows are added, no shuffle."""
    return df.where(uniform(key, salt) < share)


def resample(
    df: DataFrame, key, columns: Sequence[str], salt: str, draw_id: str = "draw"
) -> DataFrame:
    """As many draws with replacement as there are rows: (draw, columns).

    Rows are numbered by hash rank; draw d takes the row numbered floor(u(d) * n).
    """
    numbered = rank_by_hash(df, key, salt + "-index", "__i").select(
        (F.col("__i") - 1).alias("__i"), *columns
    )
    total = df.agg(F.count("*").alias("n")).scalar()
    draws = rank_by_hash(df.select(*keys_of(key)), key, salt + "-draw", draw_id).select(
        (F.col(draw_id) - 1).alias(draw_id)
    )
    chosen = draws.withColumn("__i", F.floor(uniform(draw_id, salt) * total).cast("long"))
    return chosen.join(numbered, "__i").select(draw_id, *columns)


def keys_of(key) -> list[str]:
    return [key] if isinstance(key, str) else [k for k in key if isinstance(k, str)]


def stratum_sizes(df: DataFrame, share: float, by: Sequence[str]) -> DataFrame:
    """Test rows per stratum by largest remainder, so that they sum to ceil(share * n)."""
    by = list(by)
    counts = df.groupBy(*by).agg(F.count("*").alias("rows"))
    counts = counts.withColumn("__whole", F.sum("rows").over(Window.partitionBy()))
    exact = F.col("rows") * F.lit(share)
    parts = counts.select(
        *by,
        "rows",
        F.ceil(F.round(F.col("__whole") * F.lit(share), 9)).cast("long").alias("__target"),
        F.floor(exact).cast("long").alias("__base"),
        F.round(exact - F.floor(exact), 9).alias("__rest"),
    )
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("__rest"), *by))
    spare = F.col("__target") - F.sum("__base").over(Window.partitionBy())
    return parts.select(
        *by, "rows", (F.col("__base") + (place <= spare).cast("long")).alias("test_rows")
    )


def split_train_test(
    df: DataFrame, key, test_share: float, salt: str, stratify: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Mark each row in `is_test`; the test part has exactly ceil(share * n) rows.

    No row moves: cut-offs are worked out from counts, then the mark is a comparison.
    """
    if not stratify:
        total = F.ceil(F.round(F.col("__total") * F.lit(test_share), 9))
        cut = hash_cutoffs(df, key, salt, total, digits=digits).select("cutoff")
        return df.withColumn("is_test", F.coalesce(digest(key, salt) <= cut.scalar(), F.lit(False)))
    sizes = stratum_sizes(df, test_share, stratify)
    return _split_by_sizes(df, key, salt, stratify, sizes, "test_rows", "is_test", digits)


def _split_by_sizes(df, key, salt, by, sizes, column, mark, digits=None) -> DataFrame:
    # a stratum of size 0 has no cut-off, and its rows are looked up in vain
    cuts = hash_cutoffs(df, key, salt, F.col(column), sizes.select(*by, column), by, digits)
    marked = attach_group_stats(df, by, cuts.select(*by, F.col("cutoff").alias("__cutoff")))
    inside = F.coalesce(digest(key, salt) <= F.col("__cutoff"), F.lit(False))
    return marked.withColumn(mark, inside).drop("__cutoff")


def split_counts(
    df: DataFrame, key, train: int, test: int, salt: str, stratify: Sequence[str]
) -> DataFrame:
    """Exact numbers of train and test rows with the classes in proportion; 'part' tells which."""
    by = list(stratify)
    n = df.count()
    if train + test > n:
        raise ValueError("more rows asked for than there are")
    first = stratum_sizes(df, train / n, by).withColumnRenamed("test_rows", "first_rows")
    both = stratum_sizes(df, (train + test) / n, by).drop("rows")
    sizes = join_null_safe(first, both.withColumnRenamed("test_rows", "both_rows"), by)
    marked = _split_by_sizes(df, key, salt, by, sizes, "first_rows", "__train")
    marked = _split_by_sizes(marked, key, salt, by, sizes, "both_rows", "__any")
    part = F.when(F.col("__train"), "train").when(F.col("__any"), "test").otherwise("rest")
    return marked.withColumn("part", part).drop("__train", "__any")


def assign_folds(
    df: DataFrame, key, folds: int, salt: str, stratify: Sequence[str] = ()
) -> DataFrame:
    """Fold number 0..folds-1 per row, sizes equal to within one (per class if stratified)."""
    ranked = rank_by_hash(df, key, salt, "__rank", by=stratify)
    return ranked.withColumn("fold", F.pmod(F.col("__rank") - 1, F.lit(folds)).cast("int")).drop("__rank")
