"""Filters, groupings, reshaping and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .joins import attach_group_stats
from .ordered import cumulate, quantiles, quantiles_of_counted, row_positions


# ---- filters -------------------------------------------------------------------
def keep_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is listed; Spark pushes the list, or its ends, to the scan.

    A list that is a table of its own is a job for `joins.common_rows`.
    """
    return df.where(F.col(column).isin(list(values)))


def fill_from_lookup(
    df: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default: Column
) -> DataFrame:
    """Left lookup with a default where the key has no entry."""
    return df.join(table, list(keys), "left").withColumn(value, F.coalesce(F.col(value), default))


# ---- aggregates ------------------------------------------------------------------
def group(df: DataFrame, by: Sequence[str], drop_null_keys: bool = False):
    """`groupBy` in which rows with a missing key are a group of their own, or are left out."""
    return (df.dropna(subset=list(by)) if drop_null_keys and by else df).groupBy(*by)


def summary_by_group(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    decimals: int = 3,
    drop_null_keys: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Mean, median, non-missing count and peak of a value per group."""
    if drop_null_keys:
        df = df.dropna(subset=list(by))
    plain = df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.count(value).alias("n"), F.max(value).alias("peak")
    )
    middle = quantiles(df, value, {"median": 0.5}, by, accuracy).drop("n")
    on = [plain[k].eqNullSafe(middle[k]) for k in by]
    joined = plain.join(middle, on, "left").select(*[plain[k] for k in by], "mean", "median", "n", "peak")
    return joined.withColumns({c: F.bround(c, decimals) for c in ("mean", "median", "peak")})


def summarise(df: DataFrame, value: str, method: str = "mean", decimals: int = 2) -> DataFrame:
    """One number by the named method; an unknown method or an empty input is an error."""
    if method == "mean":
        out = df.agg(F.count(value).alias("n"), F.avg(value).alias("value"))
    elif method == "median":
        found = quantiles(df, value, {"value": 0.5})
        out = found.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("value").alias("value"))
    else:
        raise ValueError(f"unknown method: {method!r}")
    rounded = F.bround("value", decimals)
    empty = F.raise_error(F.lit("can't summarise an empty input"))
    return out.select(F.when(F.col("n") == 0, empty).otherwise(rounded).alias("value"))


# The characters that separate words (Unicode white space and separators).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def words_of(text: Column | str) -> Column:
    """Blank-separated words of a whole text; neighbouring blanks leave empty words to drop.

    Every blank becomes a space first, because a one-character split needs no pattern matching.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.split(F.translate(c, BLANKS, " " * len(BLANKS)), " ")


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each blank-separated word occurs in the whole texts."""
    words = df.select(F.explode(words_of(text)).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order; each task keeps k rows, so nothing is fully sorted."""
    return df.orderBy(*order).limit(k)


def shares(df: DataFrame, label: Column, order: Sequence[str], decimals: int = 1) -> DataFrame:
    """Percent of rows per label, in the order given; labels without rows are 0."""
    counts = df.groupBy(label.alias("label")).agg(F.count("*").alias("n")).where("label is not null")
    rank = df.sparkSession.createDataFrame(list(enumerate(order)), "rank int, label string")
    full = rank.join(counts, "label", "left").fillna(0, ["n"])
    percent = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    return full.select("rank", "label", "n", F.round(percent, decimals).alias("percent"))


def null_report(df: DataFrame) -> DataFrame:
    """Missing values over all columns, in one pass."""
    missing = [F.count_if(F.col(c).isNull()) for c in df.columns]
    return df.agg(F.count("*").alias("rows"), sum(missing[1:], missing[0]).alias("nulls"))


def group_pools(
    df: DataFrame, by: Sequence[str], value: str, tie: str, chunk_rows: int = 1000
) -> DataFrame:
    """Each group's values in order, as arrays of at most `chunk_rows`.

    A group is a run of chunks rather than one array, so no row grows with the data.
    Returns (by, chunk, n, values); every value is in exactly one chunk.
    """
    placed = row_positions(df.select(*by, value, tie), value, tie, "__pos", by)
    chunk = F.floor((F.col("__pos") - 1) / F.lit(chunk_rows)).cast("long")
    pooled = placed.groupBy(*by, chunk.alias("chunk")).agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(value)).alias("values")
    )
    return pooled


def largest_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key of the largest value; ties go to the smallest key."""
    first = df.orderBy(F.desc(value), F.asc(key)).limit(1)
    return first.select(F.col(key).alias("key"), F.col(value).alias("value"))


def most_common(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(1)


def pivot_mean(df: DataFrame, rows: str, columns: str, values: Sequence, value: str) -> DataFrame:
    """Rows by columns table of means. The column values are given, which saves a job."""
    return df.groupBy(rows).pivot(columns, list(values)).agg(F.avg(value))


def means_in_order(df: DataFrame, by: str, values: Sequence[str], order: Sequence) -> DataFrame:
    """Group means of several columns, one row per listed group in the listed order."""
    kind = df.schema[by].dataType.simpleString()
    rank = df.sparkSession.createDataFrame(list(enumerate(order)), f"rank int, `{by}` {kind}")
    means = keep_values(df, by, list(order)).groupBy(by).agg(*[F.avg(v).alias(v) for v in values])
    return rank.join(means, by, "left")


def summary(df: DataFrame, value: str) -> DataFrame:
    """n, mean, median, sample and population deviation, interquartile range.

    All from one table of counted distinct values; an empty table has n = 0 and no statistics.
    """
    rows = df.select(F.col(value).cast("double").alias("__v"))
    counted = written(cumulate(rows, "__v"), "counted")
    n, v, w = F.sum("n"), F.col("__v"), F.col("n")
    mean = counted.agg((F.sum(v * w) / n).alias("m"))
    squares = F.sum(w * F.pow(v - mean.scalar(), 2))
    plain = counted.agg(
        F.coalesce(n, F.lit(0)).alias("n"),
        (F.sum(v * w) / n).alias("mean"),
        F.sqrt(F.try_divide(squares, n - 1)).alias("std_sample"),
        F.sqrt(squares / n).alias("std_population"),
    )
    q = quantiles_of_counted(counted, "__v", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = q.select((F.col("q3") - F.col("q1")).alias("iqr")).scalar()
    return plain.select("n", "mean", q.select("median").scalar().alias("median"), "std_sample", "std_population", iqr.alias("iqr"))


def relative_gap(df: DataFrame, group: str, value: str, base: str, other: str) -> DataFrame:
    """Percent difference of two group means, and how much an axis cut at 98 % exaggerates."""
    means = df.agg(
        F.avg(F.when(F.col(group) == base, F.col(value))).alias("base_mean"),
        F.avg(F.when(F.col(group) == other, F.col(value))).alias("other_mean"),
    )
    floor = F.col("base_mean") * 0.98
    return means.select(
        "base_mean",
        "other_mean",
        ((F.col("other_mean") - F.col("base_mean")) / F.col("base_mean") * 100).alias("gap_percent"),
        (F.col("base_mean") / (F.col("base_mean") - floor)).alias("exaggeration"),
    )


# ---- set operations and reshaping -----------------------------------------------------
def union_indexed(parts: Sequence[DataFrame], order: str, tie: str, name: str = "row_index") -> DataFrame:
    """All rows of all parts with a fresh 0-based index over a declared order."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    placed = row_positions(whole, order, tie, name)
    return placed.withColumn(name, F.col(name) - 1)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in a declared order.

    Spark keeps one row per key in every task before the shuffle (group limit), so a
    key that fills a third of the table sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__r", place).where("__r = 1").drop("__r")


def mark_duplicates(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """True on every row after the first of its key. `order` must name a row within its key.

    The first row per key is an aggregate (combined before the shuffle) looked up by
    each row, instead of a window that would hold a big key in one task.
    """
    first = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__first"))
    looked = attach_group_stats(df, keys, first)
    return looked.withColumn("is_duplicate", F.struct(*order) != F.col("__first")).drop("__first")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Equality of two tables as bags of rows, by counting rows from both sides."""
    counted = a.withColumn("__s", F.lit(1)).unionByName(b.withColumn("__s", F.lit(-1)))
    return counted.groupBy(*a.columns).agg(F.sum("__s").alias("d")).where("d <> 0").isEmpty()


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable", value: str = "value"
) -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


# ---- windows ------------------------------------------------------------------------------
def above_group_median(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Each row with its group's median and whether it lies above it."""
    middle = quantiles(df, value, {"group_median": 0.5}, by).drop("n")
    looked = attach_group_stats(df, by, middle)
    return looked.withColumn("above", F.col(value) > F.col("group_median"))


def group_size(df: DataFrame, by: Sequence[str], name: str = "k") -> DataFrame:
    """Size of each row's group."""
    sizes = df.groupBy(*by).agg(F.count("*").alias(name))
    return attach_group_stats(df, by, sizes)


def daily_series(df: DataFrame, ts: str, unit: str = "day", **aggregates: Column) -> DataFrame:
    """One row per calendar bucket that occurs."""
    bucket = F.date_trunc(unit, F.col(ts)).cast("date").alias("bucket")
    return df.groupBy(bucket).agg(*[c.alias(n) for n, c in aggregates.items()])


def resample_calendar(
    df: DataFrame, ts: str, unit: str = "day", fill: Mapping[str, object] | None = None, **aggregates: Column
) -> DataFrame:
    """One row per calendar bucket between the first and the last, gaps included."""
    series = daily_series(df, ts, unit, **aggregates)
    ends = series.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    step = F.expr(f"interval 1 {unit}")
    calendar = ends.select(F.explode(F.sequence("lo", "hi", step)).alias("bucket"))
    full = calendar.join(series, "bucket", "left")
    return full.fillna(dict(fill)) if fill else full


def moving_mean(
    df: DataFrame,
    order: str,
    value: str,
    before: int,
    after: int = 0,
    min_periods: int | None = None,
    name: str = "moving_mean",
    block: int = 100_000,
) -> DataFrame:
    """Mean over a span of neighbouring rows of a series with unique order values.

    NULL until `min_periods` values are in the span (default: the full span). The series
    is cut into blocks by position; rows near a block's edge are copied to the neighbour
    block, so the window runs per block and still sees its whole span.
    """
    need = before + after + 1 if min_periods is None else min_periods
    block = max(block, before + after + 1)
    placed = row_positions(df, order, order, "__pos")
    home = F.floor(F.col("__pos") / block).cast("long")
    # a row is wanted wherever a span that holds it is centred
    low = F.floor((F.col("__pos") - after) / block).cast("long")
    high = F.floor((F.col("__pos") + before) / block).cast("long")
    copies = placed.withColumn("__home", home).withColumn("__block", F.explode(F.sequence(low, high)))
    span = Window.partitionBy("__block").orderBy("__pos").rowsBetween(-before, after)
    mean = F.when(F.count(value).over(span) >= need, F.avg(value).over(span))
    out = copies.withColumn(name, mean).where("__home = __block")
    return out.select(*df.columns, name)


def running_mean(df: DataFrame, order: str, value: str) -> DataFrame:
    """Mean of all values up to and including each order value."""
    summed = cumulate(df, order, {"s": F.sum(value), "n": F.count(value)})
    total = F.coalesce(F.col("s"), F.lit(0)) + F.col("before_s")
    seen = F.col("n") + F.col("before_n")
    return summed.select(order, seen.alias("seen"), F.try_divide(total, seen).alias("running_mean"))


def centre(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Subtract the column mean, over the table or per group."""
    means = [F.avg(c).alias(f"__m_{c}") for c in columns]
    if by:
        looked = attach_group_stats(df, by, df.groupBy(*by).agg(*means))
    else:
        looked = df.withColumn("__s", df.agg(F.struct(*means)).scalar())
        looked = looked.select(*df.columns, "__s.*")
    return looked.withColumns({c: F.col(c) - F.col(f"__m_{c}") for c in columns}).select(*df.columns)


def scale_unit(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Min-max scale to [0, 1]; a constant column becomes 0; an empty table is an error."""
    ends = [F.min(column).alias("__lo"), F.max(column).alias("__hi")]
    if by:
        looked = attach_group_stats(df, by, df.groupBy(*by).agg(*ends))
    else:
        if df.isEmpty():
            raise ValueError("can't scale an empty table")
        looked = df.withColumn("__s", df.agg(F.struct(*ends)).scalar()).select(*df.columns, "__s.*")
    width = F.col("__hi") - F.col("__lo")
    scaled = F.when(width == 0, 0.0).otherwise((F.col(column) - F.col("__lo")) / width)
    return looked.withColumn(column, F.when(F.col(column).isNotNull(), scaled)).select(*df.columns)
