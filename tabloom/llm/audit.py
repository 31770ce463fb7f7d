"""Filter interaction audit: what each filter removes, whatever the order in which filters are applied.

One pass of a finite-state transducer over the UTF-8 bytes of a text, driven by two tables, counts
code points, capitals and symbols and finds the words. The word spans go into a hash table, where
equal hashes are verified byte by byte, so the number of distinct words is exact. The outcomes of
all filters become one bit mask per document; orders of filters are worked out on the counts of
masks, of which there are few, and not on documents.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from itertools import permutations
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..session import ship_package, written
from .textbytes import U64, mix, slices, text_buffer

OUTSIDE, INSIDE = 0, 1  # states: is the byte before part of a word?
SPACE, CAPITAL, SYMBOL, TAIL, OTHER = range(5)  # classes of bytes; TAIL: a later byte of a code point
STARTS, STOPS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16  # what a transition says
SYMBOLS = "#$%&*|"
WINDOW = 1 << 20  # bytes that the transducer reads at a time
SLICE = 4 << 20  # bytes of texts that share a hash table; a longer text has one of its own
LONG = 256  # bytes; longer words are hashed and compared one by one
MEASURES = ["words", "distinct_words", "capitals", "code_points", "symbols"]


def byte_classes(symbols: str = SYMBOLS) -> np.ndarray:
    """The class of each byte."""
    classes = np.full(256, OTHER, np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = SPACE
    classes[ord("A") : ord("Z") + 1] = CAPITAL
    classes[[ord(c) for c in symbols]] = SYMBOL
    classes[0x80:0xC0] = TAIL
    return classes


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, action) of each state and class."""
    after, action = np.zeros((2, 5), np.uint8), np.zeros((2, 5), np.uint8)
    for state in (OUTSIDE, INSIDE):
        for kind in (SPACE, CAPITAL, SYMBOL, TAIL, OTHER):
            after[state, kind] = OUTSIDE if kind == SPACE else INSIDE
            said = STOPS if kind == SPACE and state == INSIDE else 0
            said |= STARTS if kind != SPACE and state == OUTSIDE else 0
            said |= {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(kind, 0) | (IS_POINT if kind != TAIL else 0)
            action[state, kind] = said
    return after, action


AFTER, ACTION = transitions()
# the state after a byte depends on its class alone, so a window's states come from one look-up
assert (AFTER[OUTSIDE] == AFTER[INSIDE]).all()


class Transducer:
    """Reads the bytes of a batch window by window, and carries its state from one to the next."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
        self.data, self.offsets, self.classes = data, offsets, classes
        texts = len(offsets) - 1
        self.capitals, self.points, self.symbols = (np.zeros(texts, np.int64) for _ in range(3))
        self.state, self.open = OUTSIDE, np.zeros(0, np.int64)

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and ends of the words that end in each window."""
        for a in range(0, len(self.data), WINDOW):
            yield self._read(a, min(a + WINDOW, len(self.data)))

    def _read(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        kinds = self.classes[self.data[a:b]]
        after = AFTER[OUTSIDE][kinds]
        before = np.concatenate([[self.state], after[:-1]]).astype(np.uint8)
        first, last = np.searchsorted(self.offsets, a), np.searchsorted(self.offsets, b)
        edges = self.offsets[first:last]  # texts begin here, in state OUTSIDE
        ended = edges[edges > a]
        ended = np.unique(ended[after[ended - a - 1] == INSIDE])  # words that end with their text
        if len(edges) and edges[0] == a and self.state == INSIDE:
            ended = np.concatenate([[a], ended])
        before[edges - a] = OUTSIDE
        said = ACTION[before, kinds]
        self.state = after[-1]
        if b == len(self.data) and self.state == INSIDE:
            ended = np.concatenate([ended, [b]])
        starts = np.concatenate([self.open, np.flatnonzero(said & STARTS) + a])
        ends = np.sort(np.concatenate([np.flatnonzero(said & STOPS) + a, ended]))
        self._count(said, a, b)
        self.open = starts[len(ends) :]
        return starts[: len(ends)], ends

    def _count(self, said: np.ndarray, a: int, b: int) -> None:
        first = np.searchsorted(self.offsets, a, "right") - 1
        last = np.searchsorted(self.offsets, b)
        cuts = np.clip(self.offsets[first : last + 1], a, b) - a
        for flag, counts in ((IS_CAPITAL, self.capitals), (IS_POINT, self.points), (IS_SYMBOL, self.symbols)):
            sums = np.concatenate([[0], np.cumsum((said & flag) > 0)])
            counts[first:last] += np.diff(sums[cuts])


class SpanTable:
    """Hash table of (text, word): open addressing with linear probing, whole arrays at a time."""

    def __init__(self, data: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        # the eight bytes from any position on
        self.eights = np.ndarray(len(data) + 1, "<u8", self.data, 0, (1,))
        self.slots = np.zeros(1 << 12, np.int64)  # number of the entry plus one
        empty = np.zeros(0, np.int64)
        self.start, self.size, self.text, self.hash = empty, empty, empty, empty.astype(np.uint64)

    def _piece(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return self.eights[at] & MASKS[np.minimum(left, 8)]

    def hashes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        found = size.astype(np.uint64)
        long = size > LONG
        go, done = np.flatnonzero(~long), 0
        while len(go):
            found[go] = mix(found[go] ^ self._piece(start[go] + done, size[go] - done))
            done += 8
            go = go[size[go] > done]
        for k in np.flatnonzero(long):
            whole = self.data[start[k] : start[k] + size[k]]
            found[k] = int.from_bytes(blake2b(whole, digest_size=8).digest(), "little")
        return found

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Are entries a and b the same word of the same text? Compares every byte."""
        same = (self.hash[a] == self.hash[b]) & (self.text[a] == self.text[b]) & (self.size[a] == self.size[b])
        go, done = np.flatnonzero(same & (self.size[a] <= LONG)), 0
        while len(go):
            left = self.size[a[go]] - done
            held = self._piece(self.start[a[go]] + done, left) == self._piece(self.start[b[go]] + done, left)
            same[go[~held]] = False
            done += 8
            go = go[held & (left > 8)]
        for k in np.flatnonzero(same & (self.size[a] > LONG)):
            x, y, n = self.start[a[k]], self.start[b[k]], self.size[a[k]]
            same[k] = np.array_equal(self.data[x : x + n], self.data[y : y + n])
        return same

    def _grow(self, entries: int) -> None:
        """Make room; what is held is distinct, so it only looks for empty slots."""
        capacity = len(self.slots)
        while capacity < 2 * entries:
            capacity *= 2
        if capacity > len(self.slots):
            self.slots = np.zeros(capacity, np.int64)
            go = np.arange(len(self.start))
            at = self._home(go)
            while len(go):
                free = self.slots[at] == 0
                self.slots[at[free]] = go[free] + 1
                rest = self.slots[at] != go + 1
                go, at = go[rest], (at[rest] + 1) & (capacity - 1)

    def _home(self, entries: np.ndarray) -> np.ndarray:
        spread = mix(self.hash[entries] ^ (self.text[entries].astype(np.uint64) * U64(0x9E3779B97F4A7C15)))
        return (spread & U64(len(self.slots) - 1)).astype(np.int64)

    def insert(self, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The texts of the words that are new, once for each."""
        held, size = len(self.start), end - start
        self._grow(held + len(start))
        self.hash = np.concatenate([self.hash, self.hashes(start, size)])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.text = np.concatenate([self.text, text])
        go = np.arange(held, len(self.start))
        at, mask = self._home(go), len(self.slots) - 1
        new, places = [], []
        while len(go):
            free = self.slots[at] == 0
            self.slots[at[free]] = go[free] + 1  # of several the last one stays
            there = self.slots[at] - 1
            mine = there == go
            new.append(go[mine])
            places.append(at[mine])
            go, at, there = go[~mine], at[~mine], there[~mine]
            other = ~self._equal(go, there)
            go, at = go[other], (at[other] + 1) & mask
        new, places = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (new, places))
        self.slots[places] = held + np.arange(len(new)) + 1
        keep = np.concatenate([np.arange(held), new])
        self.start, self.size, self.text, self.hash = (x[keep] for x in (self.start, self.size, self.text, self.hash))
        return self.text[held:]


MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def measures(texts: pa.Array, classes: np.ndarray) -> list[np.ndarray]:
    """MEASURES of each text."""
    data, offsets = text_buffer(texts)
    words, distinct = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    pass_, table = Transducer(data, offsets, classes), SpanTable(data)
    for starts, ends in pass_.windows():
        text = np.searchsorted(offsets, starts, "right") - 1
        words += np.bincount(text, minlength=len(texts))
        distinct += np.bincount(table.insert(starts, ends, text), minlength=len(texts))
    return [words, distinct, pass_.capitals, pass_.points, pass_.symbols]


def measure(docs: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """All columns but `text`, and words, distinct_words, capitals, code_points and symbols as long.

    Words are runs of bytes other than space and 0x09-0x0D, told apart by case; capitals are A-Z;
    `symbols` are ASCII characters. A missing text is empty and has zeros. Each row is measured on
    its own, so repeated rows get equal numbers. Columns called like the new ones are replaced; an
    empty table stays empty. A very long text is read a window at a time; its distinct words are held.
    """
    docs = docs.drop(*MEASURES)
    keep = [c for c in docs.columns if c != "text"]
    schema = StructType([docs.schema[c] for c in keep])
    for name in MEASURES:
        schema = schema.add(name, LongType())
    classes = byte_classes(symbols)
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                found = measures(batch.column(len(keep)), classes)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *map(pa.array, found)], [*keep, *MEASURES])

    return docs.select(*keep, "text").mapInArrow(run, schema)


class Filter(NamedTuple):
    """A letter, and when a document fails, from its measures (and `repeats`: a smaller id has the same text)."""

    letter: str
    fails: Column


def standard_filters(min_words: int = 200, min_distinct: int = 50, max_capitals: int = 2) -> list[Filter]:
    """A short, B repeats words, C capitals (percentages), D holds symbols, E repeats a document."""
    return [
        Filter("A", F.col("words") < min_words),
        Filter("B", 100 * F.col("distinct_words") < min_distinct * F.col("words")),
        Filter("C", 100 * F.col("capitals") > max_capitals * F.col("code_points")),
        Filter("D", F.col("symbols") > 0),
        Filter("E", F.col("repeats")),
    ]


def outcomes(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] | None = None) -> DataFrame:
    """(doc_id, part, mask, good, toxic), one row per row of `docs`: bit k of `mask` is set if filter k fails it.

    `part` is the source, empty if missing. A text repeats another if that has a smaller doc_id;
    rows without an id, and rows of the same id, never do so. Texts are told apart by SHA-256 over
    the whole text. A document that is labelled more than once is good (toxic) if any label says so;
    unlabelled ones are neither. Groups of copies aren't gathered: their smallest id is aggregated,
    and looked up by a join whose big groups Spark can split.
    """
    filters = standard_filters() if filters is None else filters
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"), "text"
    )
    known = written(measure(docs), "measured")
    groups = known.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    several = written(groups.where("n > 1").select("sha", "first"), "copies")
    judged = known.join(several, "sha", "left")
    judged = judged.withColumn("repeats", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    mask = F.lit(0)
    for k, f in enumerate(filters):
        mask = mask + F.when(f.fails, 1 << k).otherwise(0)
    judged = judged.select("doc_id", "part", mask.alias("mask"))
    said = labels.where("doc_id is not null").groupBy("doc_id")
    said = said.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    joined = judged.join(said, "doc_id", "left")
    no = F.lit(False)
    return joined.select("doc_id", "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def orders(letters: Sequence[str]) -> list[dict]:
    """Each step of each order: the bits of the filters before it, and its own bit."""
    steps = []
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[k] for k in order), 0
        for step, k in enumerate(order, 1):
            steps.append({"filter_order": name, "step": step, "before": before, "bit": 1 << k})
            before |= 1 << k
    return steps


def interactions(found: DataFrame, letters: Sequence[str]) -> DataFrame:
    """One row per part, order of filters and step, from `outcomes`; zeros included.

    kept after the step; removed by it; redundant: fails its filter but was removed before;
    unique_fails: fails its filter only; good_lost and toxic_lost among the removed; shapley: what
    its filter removes, summed over all orders (a document that fails m filters is removed by each
    of them in one m-th of the orders). Documents are counted by (part, mask, labels) first; a part
    has at most 4 * 2^filters such counts. An empty table gives an empty one.
    """
    k = len(letters)
    if k > 7:
        raise ValueError("at most 7 filters: their orders are written out")
    counts = found.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    cells = F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells")
    parts = counts.groupBy("part").agg(cells)
    plan = F.from_json(
        F.lit(json.dumps(orders(letters))), "array<struct<filter_order:string,step:int,before:int,bit:int>>"
    )
    steps = parts.select("part", "cells", F.explode(plan).alias("s")).select("part", "cells", "s.*")

    def total(test, weight=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("cells", test), F.lit(0).cast("long"), lambda sum_, c: sum_ + weight(c))

    bit, before = F.col("bit"), F.col("before")

    def fails(c: Column) -> Column:
        return c["mask"].bitwiseAND(bit) != 0

    def here(c: Column) -> Column:
        return fails(c) & (c["mask"].bitwiseAND(before) == 0)

    def share(c: Column) -> Column:
        return (c["n"] * F.lit(factorial(k)) / F.bit_count(c["mask"])).cast("long")

    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: c["mask"].bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda c: fails(c) & (c["mask"].bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda c: c["mask"] == bit).alias("unique_fails"),
        total(lambda c: here(c) & c["good"]).alias("good_lost"),
        total(lambda c: here(c) & c["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] | None = None) -> DataFrame:
    """`interactions` of the filters over whole texts; see `outcomes` for missing values, ties and repeated rows."""
    filters = standard_filters() if filters is None else filters
    return interactions(outcomes(docs, labels, filters), [f.letter for f in filters])
