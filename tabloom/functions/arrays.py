"""Arithmetic on numeric arrays with Spark's higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import as_column


def item(array: Column | str, index: int) -> Column:
    """Element by 0-based index, counted from the end when negative; NULL out of range."""
    return F.try_element_at(as_column(array), F.lit(index + 1 if index >= 0 else index))


def add(a: Column | str, b: Column | str) -> Column:
    """Element-wise sum. Unequal lengths are an error, never padded with NULL."""
    a, b = as_column(a), as_column(b)
    same = F.size(a) == F.size(b)
    return F.when(same, F.zip_with(a, b, lambda x, y: x + y)).otherwise(
        F.raise_error(F.lit("arrays of unequal length"))
    )


def scale(a: Column | str, k: float) -> Column:
    return F.transform(as_column(a), lambda x: x * F.lit(k))


def equal(a: Column | str, b: Column | str) -> Column:
    return as_column(a) == as_column(b)


def total(a: Column | str) -> Column:
    return F.aggregate(F.transform(as_column(a), lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x)
