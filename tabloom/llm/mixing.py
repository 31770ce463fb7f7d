"""Mixing sources to target weights: whole repetitions plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .names import fresh

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; a missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Give the sources, by code point and NULL last, the weights in turn. One row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int")))


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, weight, source_size) -> with target and rate.

    The targets share `share` times all sizes by weight. One above `most` times its source's size
    stops there and the excess is shared among the others again, until none is above. Only a few
    sums over the sources reach the driver. A source without words has target and rate 0.
    """
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cap = F.lit(float(most)) * F.col("source_size")
    level, capped = None, -1
    while True:
        stopped = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        n, taken, weight = sizes.agg(
            F.count_if(stopped),
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not weight:
            break
        level, capped = (share * total - taken) / weight, n
    target = F.least(cap, F.col("weight") * F.lit(level or 0.0))
    size = F.col("source_size")
    return sizes.withColumn("target", target).withColumn("rate", F.when(size > 0, F.col("target") / size).otherwise(0.0))


def hash_uniform(salt: str, *keys: Column) -> Column:
    """A number in [0, 1) from 13 hexadecimal digits of a digest of the keys."""
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    digits = F.substring(F.md5(F.concat_ws("-", F.lit(salt), *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def plan_mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, salt: str = "mix"
) -> DataFrame:
    """Every document with size, source_size, target, rate and copies, how often the mix takes it.

    A document is taken floor(rate) times, and once more where the hash of its id and text falls
    below the fraction, so reruns agree in any partitioning. Missing texts are empty (size 0);
    documents without a source are a source of their own. Rows that repeat id and text share their
    fate. A very long text counts with all its words, so a source of few unequal documents may
    end further from its target: copies are drawn independently, and the expected deviation is the
    root of the sum of size^2 * f * (1 - f), f the fraction of the source's rate. Columns called like the new ones are replaced; an empty table stays empty.
    """
    new = ["size", "source_size", "target", "rate", "copies"]
    docs = docs.drop(*new)
    sized = docs.select("source", word_count(F.col("text")).alias("size"))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source; written, so that its size is known to the join below
    sources = written(cycled_weights(sums, weights), "sources")
    own = fresh(docs, "__source")
    targets = source_targets(sources, share, most).withColumnRenamed("source", own).drop("weight")
    u = hash_uniform(salt, F.col("doc_id"), F.col("text"))
    whole = F.floor("rate")
    copies = whole + F.when(u < F.col("rate") - whole, 1).otherwise(0)
    joined = docs.join(targets, F.col("source").eqNullSafe(F.col(own))).drop(own)
    joined = joined.withColumn("size", word_count(F.col("text")))
    return joined.withColumn("copies", copies.cast("int")).select(*docs.columns, *new)


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: the columns of `docs`, each row as often as the mix takes it."""
    planned = plan_mix(docs, **settings).where("copies > 0")
    return planned.withColumn(fresh(planned, "__copy"), F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)
