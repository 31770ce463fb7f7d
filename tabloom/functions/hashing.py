"""Randomness taken from hashed row keys.

The same row gets the same number whatever the partitioning, the number of
retries or the engine: the number is read off md5(key-salt).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = float(2**32)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def digest(keys: str | Column | Sequence[str | Column], salt: str | Column) -> Column:
    """md5 of the key columns and a salt, joined by '-'. Its text order is the hash order."""
    parts = [keys] if isinstance(keys, (str, Column)) else list(keys)
    last = salt if isinstance(salt, Column) else F.lit(salt)
    return F.md5(F.concat_ws("-", *[as_column(k).cast("string") for k in parts], last.cast("string")))


def slice_uniform(hexed: Column, part: int = 0) -> Column:
    """Uniform on [0,1) from one of the four 32-bit slices of a digest."""
    return F.conv(F.substr(hexed, F.lit(1 + 8 * part), F.lit(8)), 16, 10).cast("double") / TWO_32


def uniform(keys: str | Column | Sequence[str | Column], salt: str | Column) -> Column:
    """Uniform on [0,1) per row."""
    return slice_uniform(digest(keys, salt))


def open_uniform(keys: str | Column | Sequence[str | Column], salt: str | Column) -> Column:
    """Uniform on (0,1): safe under a logarithm."""
    return uniform(keys, salt) + F.lit(0.5 / TWO_32)


def normal(keys: str | Column | Sequence[str | Column], salt: str) -> Column:
    """Standard normal by Box-Muller from two uniforms of the same row."""
    radius = F.sqrt(-2.0 * F.log(open_uniform(keys, salt + "r")))
    return radius * F.cos(2.0 * F.pi() * uniform(keys, salt + "a"))


def laplace(u: Column, scale: Column | float) -> Column:
    """Laplace noise by the inverse distribution, from an open uniform."""
    centred = u - F.lit(0.5)
    return -F.lit(scale) * F.signum(centred) * F.log(1.0 - 2.0 * F.abs(centred))


# Cumulative distribution of a Poisson(1) count, from its definition.
def poisson_one_cdf(terms: int = 12) -> list[float]:
    import math

    total, out = 0.0, []
    for k in range(terms):
        total += math.exp(-1.0) / math.factorial(k)
        out.append(total)
    return out


def poisson_one_weight(hex8: Column) -> Column:
    """Poisson(1) count from eight hex digits, by comparing text with text (no parsing)."""
    import math

    cuts = [math.ceil(c * TWO_32) for c in poisson_one_cdf()]
    weight = None
    for k, cut in enumerate(cuts):
        if cut >= 2**32:
            break
        below = hex8 < F.lit(f"{cut:08x}")
        weight = F.when(below, k) if weight is None else weight.when(below, k)
    return weight.otherwise(len(cuts)) if len(cuts) == 12 else weight
