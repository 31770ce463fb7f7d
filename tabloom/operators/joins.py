"""Joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a missing key matches a missing key."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on: Column | None = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    validate: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join a fact table with a dimension.

    No broadcast hint: Spark broadcasts the dimension when its size allows and otherwise
    shuffles, splitting skewed keys at run time.
    """
    if validate:
        check_relationship(facts, dim, keys, validate)
    if null_safe:
        return join_null_safe(facts, dim, keys, how)
    return facts.join(dim, list(keys), how)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def check_relationship(
    left: DataFrame, right: DataFrame, keys: Sequence[str], relation: str
) -> None:
    """Raise unless the key is unique on the sides that the relation calls 'one'."""
    sides = {
        "one_to_one": ("left", "right"),
        "one_to_many": ("left",),
        "many_to_one": ("right",),
    }
    if relation not in sides:
        raise ValueError(f"unknown relation: {relation!r}")
    for side in sides[relation]:
        frame = left if side == "left" else right
        if not repeated_keys(frame, keys).isEmpty():
            raise ValueError(f"{relation}: keys repeat on the {side} side of the join")


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left table without a partner."""
    return left.join(right, list(keys), "left_anti")


def common_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows whose key occurs on the right; left duplicates stay.

    The right side is reduced to its distinct keys first (combined before the shuffle),
    so a key repeated often there costs nothing.
    """
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")


def attach_group_stats(df: DataFrame, keys: Sequence[str], stats: DataFrame) -> DataFrame:
    """Give each row the statistics of its group, whatever the group sizes.

    `stats` has one row per group. It is worked out once and written, so Spark knows its size when
    it plans the lookup: a small table is broadcast, and with a larger one both sides are plain
    shuffles, of which Spark splits the partitions that hold a big group. A missing key counts as a
    group.
    """
    values = [c for c in stats.columns if c not in keys]
    joined = join_null_safe(df, written(stats, "groups"), keys, "left")
    return joined.select(*df.columns, *values)
