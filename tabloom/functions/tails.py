"""Tail probabilities as Column expressions, for tables with one row per test."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _simpson(lower: Column, upper: Column, power: Column, steps: int) -> Column:
    """Integral of cos(x)**power by Simpson's rule."""
    h = (upper - lower) / F.lit(float(steps))

    def term(i: Column) -> Column:
        weight = F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return weight * F.pow(F.cos(lower + i * h), power)

    return (
        F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), lambda s, i: s + term(i)) * h / 3.0
    )


def t_two_sided(t: Column, df: Column, steps: int = 400) -> Column:
    """Two-sided p-value of Student's t, by integrating cos(x)**(df-1)."""
    theta = F.atan(F.abs(t) / F.sqrt(df))
    end = F.least(F.pi() / 2.0, 40.0 / F.sqrt(df))
    whole = _simpson(F.lit(0.0), end, df - 1.0, steps)
    tail = _simpson(theta, end, df - 1.0, steps)
    return F.when(theta >= end, 0.0).otherwise(tail / whole)


def smirnov(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov distance."""
    ne = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (ne + 0.12 + 0.11 / ne) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    p = F.least(F.greatest(2.0 * series, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < 0.2, 1.0).otherwise(p)


def exact_smirnov(d: Column, n1: Column, n2: Column) -> Column:
    """Probability that two samples of n1 and n2 rows without ties are at least d apart, by counting paths.

    A merged order of the samples is a path over a grid of n1 by n2 steps. The share of the paths to a
    point that have been too far off the diagonal comes from the two points before it; a whole
    diagonal is worked out at a time. The work is n1 * n2 per row, so it is meant for small samples.
    """

    @F.pandas_udf("double")
    def p(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        known = d.notna() & (n1 > 0) & (n2 > 0)
        return pd.Series(
            [_outside(int(a), int(b), round(x * a * b)) if k else None for x, a, b, k in zip(d, n1, n2, known, strict=True)], dtype=float
        )

    return p(d.cast("double"), n1.cast("double"), n2.cast("double"))


def _outside(n1: int, n2: int, far: int) -> float:
    """Share of paths that reach |i * n2 - j * n1| >= far."""
    i = np.arange(n1 + 1)
    share = np.zeros(n1 + 1)
    for s in range(1, n1 + n2 + 1):
        j = s - i
        before = np.concatenate([[0.0], share[:-1]])
        share = (before * i + share * j) / s
        share[(j < 0) | (j > n2)] = 0.0
        share[(j >= 0) & (j <= n2) & (np.abs(i * n2 - j * n1) >= far)] = 1.0
    return float(share[n1])
