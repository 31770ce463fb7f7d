"""Statistics that aren't an aggregate Column: a mergeable state, filled by tasks and merged by Spark.

A task fills one state for each (replicate, arm) from its own rows, a batch at a time. The states are
shuffled, not the rows, and merged one after the other, so no replicate's rows ever meet. How
much a state holds is up to the statistic: `Moments` three numbers, `CountedValues` one per different
value, `Binned` one per bin.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

STATES = 20_000  # states that a task holds before it hands them on
MERGED = 64  # states of a group that are held before they are merged


class Aggregator(Protocol):
    """What a user writes. A state is anything that can be pickled; merging must not care about order."""

    def zero(self) -> Any: ...

    def update(self, state: Any, values: np.ndarray, weights: np.ndarray) -> Any: ...

    def merge(self, a: Any, b: Any) -> Any: ...

    # an aggregator may have `merge_all(states)` too, if it merges many at once more cheaply

    def finish(self, state: Any) -> float: ...


class Moments:
    """A function of (sum of weights, mean, mean of squared deviations)."""

    def __init__(self, of: Callable[[float, float, float], float]):
        self.of = of

    def zero(self):
        return 0.0, 0.0, 0.0

    def update(self, state, values, weights):
        n = float(weights.sum())
        if not n:
            return state
        mean = float(values @ weights) / n
        return self.merge(state, (n, mean, float(((values - mean) ** 2) @ weights)))

    def merge(self, a, b):
        n = a[0] + b[0]
        if not n:
            return a
        gap = b[1] - a[1]
        return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n

    def finish(self, state):
        n, mean, squares = state
        return self.of(n, mean, squares / n) if n else float("nan")


class CountedValues:
    """A function of the different values in order and the weight of each: exact for any order statistic."""

    def __init__(self, of: Callable[[np.ndarray, np.ndarray], float]):
        self.of = of

    def zero(self):
        return np.zeros(0), np.zeros(0)

    def update(self, state, values, weights):
        return self.merge(state, (values, weights))

    def merge(self, a, b):
        return self.merge_all([a, b])

    def merge_all(self, states):
        values, weights = (np.concatenate(x) for x in zip(*states, strict=True))
        order = np.argsort(values, kind="stable")  # runs that are in order already are merged
        values, weights = values[order], weights[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
        values, weights = values[first], np.add.reduceat(weights, first) if len(first) else weights
        return values[weights > 0], weights[weights > 0]

    def finish(self, state):
        return float(self.of(*state)) if len(state[0]) else float("nan")


class Binned:
    """CountedValues of bin centres between `low` and `high`: a state of fixed size, for long tables."""

    def __init__(self, of: Callable[[np.ndarray, np.ndarray], float], low: float, high: float, bins: int = 4096):
        self.of, self.low, self.width, self.bins = of, low, (high - low) / bins, bins

    def zero(self):
        return np.zeros(self.bins)

    def update(self, state, values, weights):
        place = np.clip(((values - self.low) / self.width).astype(int), 0, self.bins - 1)
        return state + np.bincount(place, weights, self.bins)

    def merge(self, a, b):
        return a + b

    def finish(self, state):
        at = np.flatnonzero(state)
        return float(self.of(self.low + (at + 0.5) * self.width, state[at])) if len(at) else float("nan")


def weighted_quantile(values: np.ndarray, weights: np.ndarray, p: float) -> float:
    """Quantile with linear interpolation of values that stand for as many rows as their weight says."""
    place = p * (weights.sum() - 1)
    ends = np.cumsum(weights)
    below, above = (values[min(np.searchsorted(ends, k, "right"), len(values) - 1)] for k in (np.floor(place), np.ceil(place)))
    return float(below + (above - below) * (place - np.floor(place)))


def median() -> CountedValues:
    return CountedValues(lambda v, w: weighted_quantile(v, w, 0.5))


def trimmed_mean(share: float = 0.1) -> CountedValues:
    """Mean of what is left when floor(share * n) rows are taken off either end."""

    def of(values: np.ndarray, weights: np.ndarray) -> float:
        n = weights.sum()
        cut = np.floor(share * n)
        ends = np.cumsum(weights)
        kept = np.clip(np.minimum(ends, n - cut) - np.maximum(ends - weights, cut), 0, None)
        return float(values @ kept / kept.sum()) if kept.sum() else float("nan")

    return CountedValues(of)


def aggregate_by(df: DataFrame, by: Sequence[str], value: str, weight: str, aggregator: Aggregator, name: str) -> DataFrame:
    """(by, name): the statistic of each group of integer keys. Rows without a value or weight are left out.

    Each task hands on at most one state per group and STATES groups; the states of a group are read
    in a stream and merged into one.
    """
    ship_package(df.sparkSession)
    by = list(by)
    rows = df.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(
        *[F.col(c).cast("long").alias(c) for c in by], F.col(value).cast("double").alias("__x"), F.col(weight).cast("double").alias("__w")
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict = {}
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(len(by))]
            x, w = batch.column(len(by)).to_numpy(), batch.column(len(by) + 1).to_numpy()
            order = np.lexsort(keys[::-1])
            keys = [k[order] for k in keys]
            new = np.zeros(len(order), bool)
            new[:1] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            edges = [*np.flatnonzero(new).tolist(), len(order)]
            for a, b in zip(edges, edges[1:], strict=False):
                key = tuple(int(k[a]) for k in keys)
                state = states.get(key)
                here = order[a:b]
                states[key] = aggregator.update(aggregator.zero() if state is None else state, x[here], w[here])
            if len(states) > STATES:
                yield packed_states(states, by)
                states = {}
        if states:
            yield packed_states(states, by)

    keys = ", ".join(f"{c} long" for c in by)
    return finish_states(rows.mapInArrow(fill, f"{keys}, state binary"), by, aggregator, name)


def packed_states(states: dict, by: Sequence[str]) -> pa.RecordBatch:
    keys = list(zip(*states, strict=True)) or [()] * len(by)
    return pa.RecordBatch.from_arrays(
        [*[pa.array(k, pa.int64()) for k in keys], pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], [*by, "state"]
    )


def finish_states(states: DataFrame, by: list[str], aggregator: Aggregator, name: str) -> DataFrame:
    """(by, name) from states that tasks handed on: those of a group are read in a stream and merged, some at a time."""

    def merged(states: list) -> Any:
        if hasattr(aggregator, "merge_all"):
            return aggregator.merge_all(states)
        whole = aggregator.zero()
        for s in states:
            whole = aggregator.merge(whole, s)
        return whole

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out: list[tuple] = []
        for key, same in groupby(rows, lambda r: r[:-1]):
            held = []
            for r in same:
                held.append(pickle.loads(r[-1]))
                if len(held) == MERGED:
                    held = [merged(held)]
            out.append((*key, aggregator.finish(merged(held))))
            if len(out) >= STATES:
                yield _table(out, by, name)
                out = []
        if out:
            yield _table(out, by, name)

    keys = ", ".join(f"{c} long" for c in by)
    return states.repartition(*by).sortWithinPartitions(*by).mapInArrow(finish, f"{keys}, {name} double")


def _table(rows: list[tuple], by: list[str], name: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * len(by) + [pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*by, name])
