"""Sums, ranks and quantiles over a global order without a one-task window.

A window without a partition key would pull the whole table into one task, and a
window per group would pull a big group into one. Here the value range is cut into
buckets, windows run inside (group, bucket), and the small table of bucket totals
supplies what lies before each bucket. There is one route for all sizes: only the
number of buckets follows the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

ROWS_PER_BUCKET = 4_000_000
SAMPLE = 20_000  # rows that a first sample holds
PER_BUCKET = 10  # sampled rows per bucket at least
MOST_LITERALS = 256  # cuts that are written into a plan


def _sample(df: DataFrame, column: str, n: int) -> tuple[list, float]:
    """(values, rows): n rows drawn at random from those with a value, in order, and about how many there are."""
    drawn = df.select(F.col(column).alias("v"), F.rand(17).alias("u")).where("v is not null")
    found = drawn.orderBy("u").limit(n).collect()  # each task keeps n rows
    rows = len(found) if len(found) < n else n / found[-1]["u"]
    return _in_order([r["v"] for r in found], df, column), rows


def _in_order(values: list, df: DataFrame, column: str) -> list:
    """The values in Spark's order: texts by their bytes, NaN last; types with parts are left to Spark."""
    kind = df.schema[column].dataType
    if isinstance(kind, StringType):
        return sorted(values, key=lambda v: v.encode())
    if isinstance(kind, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
        return sorted(values, key=lambda v: (v != v, 0 if v != v else v))
    table = df.sparkSession.createDataFrame([(v,) for v in values], StructType([StructField("v", kind)]))
    return [r["v"] for r in table.orderBy("v").collect()]


def cut_points(df: DataFrame, column: str, buckets: int | None = None) -> list[Any]:
    """At most `buckets - 1` values of the column, in order, that cut it into even parts.

    They come from a random sample and steer balance only; the results below are exact for any
    cuts. Repeats are kept: a repeated cut marks a value that fills a bucket alone. Without a
    number, there are as many buckets as shuffle partitions, or one for every ROWS_PER_BUCKET rows
    if that is more.
    """
    n = max(SAMPLE, PER_BUCKET * (buckets or 0))
    ordered, rows = _sample(df, column, n)
    if buckets is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(2, parts, round(rows / ROWS_PER_BUCKET))
        if n < PER_BUCKET * buckets and rows > n:
            ordered, _ = _sample(df, column, PER_BUCKET * buckets)
    return [ordered[i * len(ordered) // buckets] for i in range(1, buckets)] if ordered else []


def put_in_buckets(df: DataFrame, column: str, cuts: Sequence, name: str) -> DataFrame:
    """Number of the left-closed bucket [cut, next cut) that holds the value: cuts at or below it.

    Up to MOST_LITERALS cuts are a constant array of the column's own type, searched by halving steps.
    More are cut into runs: the first cuts of the runs are the constant, and a run is looked up as
    a row of a table that is as small as the cuts, so planning doesn't slow down with them.
    """
    if not cuts:
        return df.withColumn(name, F.lit(0))
    kind, value = df.schema[column].dataType, F.col(column)
    if len(cuts) <= MOST_LITERALS:
        return df.withColumn(name, _at_or_below(_constant(cuts, kind), len(cuts), value))
    width = math.ceil(math.sqrt(len(cuts)))
    runs = [(k, list(cuts[k * width : (k + 1) * width])) for k in range(math.ceil(len(cuts) / width))]
    schema = StructType([StructField("__run", IntegerType()), StructField("__cuts", ArrayType(kind))])
    table = df.sparkSession.createDataFrame(runs, schema)
    run = _at_or_below(_constant([r[0] for _, r in runs], kind), len(runs), value) - 1
    found = df.withColumn("__run", run).join(F.broadcast(table), "__run", "left")
    inside = F.col("__run") * width + _at_or_below(F.col("__cuts"), width, value, F.size("__cuts"))
    return found.withColumn(name, F.when(F.col("__run") < 0, 0).otherwise(inside)).drop("__run", "__cuts")


def _constant(values: Sequence, kind: DataType) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def _at_or_below(held: Column, most: int, value: Column, size: Column | None = None) -> Column:
    """How many of an ordered array's values, at most `most`, lie at or below a value."""
    size = F.lit(most) if size is None else size
    steps = F.array(*[F.lit(2**i) for i in reversed(range(most.bit_length()))])

    def step(low: Column, by: Column) -> Column:
        fits = (low + by <= size) & (F.get(held, low + by - 1) <= value)
        return F.when(fits, low + by).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def _cell(by: Sequence[str], *parts: str) -> Column:
    """One key for (group, bucket). Structs compare missing fields as equal, so a missing
    group is a group, and window and join share one partitioning."""
    return F.struct(*by, *parts)


def cumulate(
    df: DataFrame,
    value: str,
    weights: Mapping[str, Column] | None = None,
    by: Sequence[str] = (),
    buckets: int | None = None,
    cuts: Sequence | None = None,
) -> DataFrame:
    """One row per (group, value): its weights, and the sums over all smaller values.

    `weights` are aggregate expressions, by default {'n': count(*)}. Each weight w gives
    columns w, before_w (strictly smaller values) and total_w (the whole group). Rows
    with a missing value are left out. Any type with an order will do. Cuts that are known already
    can be handed in.
    """
    weights = dict(weights or {"n": F.count(F.lit(1))})
    by = list(by)
    known = df.where(F.col(value).isNotNull())
    cuts = cut_points(known, value, buckets) if cuts is None else cuts
    summed = known.groupBy(*by, value).agg(*[w.alias(name) for name, w in weights.items()])
    placed = put_in_buckets(summed, value, cuts, "__bucket").withColumn("__cell", _cell(by, "__bucket"))
    inside = Window.partitionBy("__cell").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.select(
        *by,
        "__cell",
        value,
        *weights,
        *[F.coalesce(F.sum(w).over(inside), F.lit(0)).alias(f"__in_{w}") for w in weights],
    )
    sums = placed.groupBy(*by, "__bucket").agg(*[F.sum(w).alias(w) for w in weights])
    earlier = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = sums.select(
        _cell(by, "__bucket").alias("__cell"),
        *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"__off_{w}") for w in weights],
        *[F.sum(w).over(whole).alias(f"total_{w}") for w in weights],
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per bucket
    joined = rows.join(offsets, "__cell")
    return joined.select(
        *by,
        value,
        *weights,
        *[(F.col(f"__in_{w}") + F.col(f"__off_{w}")).alias(f"before_{w}") for w in weights],
        *[f"total_{w}" for w in weights],
    )


def place_of(p: float, n: Column) -> Column:
    """0-based place of a quantile among n ordered values."""
    return F.lit(float(p)) * (n - 1)


def covering(value: str, rank: Column, n: str = "n") -> Column:
    """Aggregate over a cumulated table: the value that holds a 0-based rank."""
    hit = (F.col(f"before_{n}") <= rank) & (rank < F.col(f"before_{n}") + F.col(n))
    return F.max(F.when(hit, F.col(value).cast("double")))


def quantiles_of_counted(counted: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), n: str = "n") -> DataFrame:
    """Quantiles with linear interpolation (by, n, one column per prob) from a cumulated table."""
    picks = [F.max(f"total_{n}").alias("__n")]
    for name, p in probs.items():
        place = place_of(p, F.col(f"total_{n}"))
        picks += [covering(value, F.floor(place), n).alias(f"__lo_{name}"), covering(value, F.ceil(place), n).alias(f"__hi_{name}")]
    found = counted.groupBy(*by).agg(*picks)
    total = F.col("__n")

    def blend(name: str, p: float) -> Column:
        lo, hi, place = F.col(f"__lo_{name}"), F.col(f"__hi_{name}"), place_of(p, total)
        part = place - F.floor(place)
        return F.when(part == 0, lo).otherwise(lo + (hi - lo) * part).alias(name)

    return found.where("__n > 0").select(*by, total.alias("n"), *[blend(k, p) for k, p in probs.items()])


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Quantiles with linear interpolation, per group, exact at any size: (by, n, one column per prob).

    All distinct values are counted and ranked: one shuffle of the distinct values.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("__value"))
    return quantiles_of_counted(cumulate(rows, "__value", by=by, buckets=buckets), "__value", probs, by)


def quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Exact quantiles, or Spark's bounded-error sketch when an accuracy is given."""
    if accuracy is None:
        return exact_quantiles(df, value, probs, by)
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        *[
            F.percentile_approx(F.col(value).cast("double"), float(p), accuracy).alias(k)
            for k, p in probs.items()
        ],
    )


def row_positions(
    df: DataFrame,
    order: str,
    tie: str,
    name: str = "position",
    by: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Every row's 1-based place in the order of (order, tie), per group; missing values come first.

    (order, tie) must name a row; both may have any type with an order. A value of `order` that
    fills buckets alone is cut again by `tie`, with cuts from that value's own rows, so even one
    value holding a third of the table is spread over many tasks.
    """
    by = list(by)
    cuts = cut_points(df, order, buckets)
    hot = [a for a, b in zip(cuts, cuts[1:], strict=False) if a == b or (a != a and b != b)]
    placed = put_in_buckets(df, order, cuts, "__bucket").withColumn("__sub", F.lit(0))
    if hot:
        kind = df.schema[order].dataType
        is_hot = F.coalesce(F.col(order).isin([F.lit(h).cast(kind) for h in {repr(h): h for h in hot}.values()]), F.lit(False))
        tie_cuts = cut_points(df.where(is_hot), tie, len(cuts) + 1)
        placed = put_in_buckets(placed, tie, tie_cuts, "__sub")
        # a hot value opens its left-closed bucket, so its rows come before the others
        placed = placed.withColumn("__sub", F.when(is_hot, F.col("__sub")).otherwise(F.lit(len(tie_cuts) + 1)))
    cells = [*by, "__bucket", "__sub"]
    inside = Window.partitionBy("__cell").orderBy(order, tie)
    sums = placed.groupBy(*cells).agg(F.count(F.lit(1)).alias("__n"))
    earlier = (
        Window.partitionBy(*by)
        .orderBy("__bucket", "__sub")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    off = F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off")
    offsets = sums.select(_cell(by, "__bucket", "__sub").alias("__cell"), off)
    ranked = placed.withColumn("__cell", _cell(by, "__bucket", "__sub")).withColumn(
        "__in", F.row_number().over(inside)
    )
    joined = ranked.join(offsets, "__cell")
    return joined.select(*df.columns, (F.col("__in") + F.col("__off")).alias(name))
