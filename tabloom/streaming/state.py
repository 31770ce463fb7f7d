"""Trailing statistics on a stream, with state of our own per key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..session import ship_package
from .runs import event_time

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


ROW = np.dtype([("key", "<i8"), ("us", "<i8"), ("id", "<i8"), ("value", "<f8")])
BUCKETS = 256  # of keys; the rows of a bucket that wait are held by one task


class TrailingMean(StatefulProcessor):
    """Mean of a key's last n values in the order of (time, id); missing until n are seen.

    The state is kept per bucket of keys, as packed rows, so that a batch costs some calls per bucket
    and not per key. Rows wait until the watermark has passed them, so late ones take their place in
    the order. The ring holds each key's last n - 1 rows. With `forget_ms`, a key without rows for
    that long, in event time, starts anew.
    """

    def __init__(self, n: int, forget_ms: int | None):
        self.n, self.forget_ms = n, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.low = handle.getValueState("low", "us long")  # of the rows that wait
        self.ring = handle.getValueState("ring", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = []
        for part in rows:
            packed = np.empty(len(part), ROW)
            for c in ROW.names:
                packed[c] = part[c].to_numpy(ROW[c])
            held.append(packed)
        held = np.concatenate(held) if held else np.empty(0, ROW)
        if len(held):
            self.waiting.appendValue((held.tobytes(),))
            first = int(held["us"].min())
            if not self.low.exists() or first < self.low.get()[0]:
                self.low.update((first,))
                self.handle.registerTimer(first // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs()
        waits = self.low.exists() and self.low.get()[0] // 1000 < passed
        if not waits and self.forget_ms is None:
            return  # an earlier timer of this batch has taken the rows
        due = np.empty(0, ROW)
        if waits:
            held = np.concatenate([np.frombuffer(r[0], ROW) for r in self.waiting.get()])
            is_due = held["us"] // 1000 < passed
            due, rest = held[is_due], held[~is_due]
            if len(rest):
                self.waiting.put([(rest.tobytes(),)])
                first = int(rest["us"].min())
                self.low.update((first,))
                self.handle.registerTimer(first // 1000 + 1)
            else:
                self.waiting.clear()
                self.low.clear()
        ring = np.frombuffer(self.ring.get()[0], ROW) if self.ring.exists() else np.empty(0, ROW)
        rows, fresh, start = self._ordered(ring, due)
        place = np.arange(len(rows))
        mean = np.full(len(rows), np.nan)
        full = np.flatnonzero(place - start >= self.n - 1)
        total = np.zeros(len(full))
        for back in range(self.n - 1, -1, -1):
            total += rows["value"][full - back]
        mean[full] = total / self.n
        self._keep(rows, start, passed)
        if len(due):
            out = {c: rows[c][fresh] for c in ROW.names} | {"mean": mean[fresh]}
            yield pd.DataFrame(out)

    def _ordered(self, ring: np.ndarray, due: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows by (key, time, id), the ring's before the due ones; which are due; and where each one's run begins."""
        rows = np.concatenate([ring, due])
        fresh = np.arange(len(rows)) >= len(ring)
        order = np.lexsort((rows["id"], rows["us"], fresh, rows["key"]))
        rows, fresh = rows[order], fresh[order]
        begins = np.ones(len(rows), bool)
        begins[1:] = rows["key"][1:] != rows["key"][:-1]
        if self.forget_ms is not None:
            begins[1:] |= rows["us"][1:] - rows["us"][:-1] > self.forget_ms * 1000
        return rows, fresh, np.maximum.accumulate(np.where(begins, np.arange(len(rows)), 0))

    def _keep(self, rows: np.ndarray, start: np.ndarray, passed: int) -> None:
        """The ring: the last rows of each key's last run, but for keys that rest for long."""
        ends = np.flatnonzero(np.append(rows["key"][1:] != rows["key"][:-1], True)) if len(rows) else np.empty(0, np.int64)
        last = np.repeat(ends, np.diff(np.append(-1, ends)))  # the last row of each row's key
        kept = (start == start[last]) & (last - np.arange(len(rows)) < max(1, self.n - 1))
        if self.forget_ms is not None:
            kept &= rows["us"][last] // 1000 + self.forget_ms >= passed
        if kept.any():
            self.ring.update((rows[kept].tobytes(),))
            if self.forget_ms is not None:
                self.handle.registerTimer(int(rows["us"][last][kept].min()) // 1000 + self.forget_ms + 1)
        else:
            self.ring.clear()

    def close(self) -> None:
        pass


def trailing_means(
    stream: DataFrame, key: str, ts: str, order: str, value: str, n: int, lateness: str, forget_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(key, ts, order, value, mean) as a stream: each row once, when the watermark has passed it.

    `key` and `order` are whole numbers; `order` tells rows of the same time apart. Rows later than
    `lateness` are dropped. A missing value counts as a row, and a mean over it is missing.
    The session must keep state in RocksDB, which this sets. Like the number of shuffle partitions, `buckets`
    can't change for a checkpoint; more of them hold fewer rows each.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    ship_package(spark)
    timed = event_time(stream, ts, lateness).select(
        F.col(key).cast("long").alias("key"), ts, F.unix_micros(F.col(ts)).alias("us"), F.col(order).cast("long").alias("id"),
        F.col(value).cast("double").alias("value"),
    ).where(f"key is not null and {ts} is not null and id is not null")
    schema = StructType().add("key", "long").add("us", "long").add("id", "long").add("value", "double").add("mean", "double")
    bucketed = timed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    means = bucketed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=TrailingMean(n, forget_ms), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    return means.select(
        F.col("key").alias(key), F.timestamp_micros("us").alias(ts), F.col("id").alias(order), F.col("value").alias(value), "mean"
    )
