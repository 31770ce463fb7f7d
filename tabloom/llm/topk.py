"""Exact top-k inner products by MaxScore.

A vector's components are its terms and a shard's column of a term is the term's postings. Score
bounds split a query's terms: those whose contributions together can't lift a candidate to the
k-th best score so far are non-essential. The essential postings are traversed, and the others
are probed only for candidates that can still get in. The shards' lists are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package, written

QUERY_BLOCK = 16_384  # queries that are broadcast at a time
SHARD_ROWS = 4096  # candidates whose postings are held at a time
EXACT = 2.0**53  # below this, sums of doubles that hold integers are exact


def _rows(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of the rows that take part; shorter vectors lack the last terms."""
    ids, vectors = batch.column(0), batch.column(1)
    ends = vectors.offsets.to_numpy()
    flat = vectors.values.slice(int(ends[0]), int(ends[-1] - ends[0])).to_numpy(zero_copy_only=False).astype(np.float64)
    ends = ends - ends[0]  # a missing component has become NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    sizes = np.diff(ends)
    use = (bad[ends[1:]] == bad[ends[:-1]]) & ~ids.is_null().to_numpy(False) & ~vectors.is_null().to_numpy(False)
    out = np.zeros((int(use.sum()), int(sizes[use].max(initial=0))))
    row = np.repeat(np.cumsum(use) - 1, sizes)
    column = np.arange(len(flat)) - np.repeat(ends[:-1], sizes)
    held = np.repeat(use, sizes)
    out[row[held], column[held]] = np.floor(scale * flat[held])
    return ids.filter(pa.array(use)).to_numpy(zero_copy_only=False).astype(np.int64), out


def _widen(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


class Best:
    """The k best (score, id) of each query so far: higher scores first, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.zeros(0)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * queries

    def bar(self, q: int) -> float:
        """The score that a candidate must reach."""
        return self.scores[q][-1] if len(self.scores[q]) == self.k else -np.inf

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[order], ids[order]


def search_shard(best: Best, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray) -> int:
    """MaxScore of all queries over one shard; returns how many postings were looked at."""
    width = max(queries.shape[1], shard.shape[1])
    queries, shard = _widen(queries, width), _widen(shard, width)
    top, low = shard.max(axis=0, initial=-np.inf), shard.min(axis=0, initial=np.inf)
    if not len(ids):
        return 0
    peak = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(width, 1)
    if peak >= EXACT:  # beyond what doubles hold exactly: 64-bit integers
        queries, shard, top, low = (x.astype(np.int64) for x in (queries, shard, top, low))
    most, least = np.maximum(queries * top, queries * low), np.minimum(queries * top, queries * low)
    postings, looked = np.asfortranarray(shard), 0
    for q, weights in enumerate(queries):
        bar = best.bar(q)
        spread = most[q] - least[q]
        order = np.argsort(spread, kind="stable")
        # even at their best, the first terms can't reach the bar if the others are at their least
        reach = least[q].sum() + np.cumsum(spread[order])
        split = int(np.searchsorted(reach, bar)) if bar > -np.inf else 0
        essential, rest = order[split:], order[:split][::-1]
        alive = np.flatnonzero(ids != query_ids[q])
        scores = (postings[:, essential] @ weights[essential])[alive]
        looked += len(ids) * len(essential)
        left = most[q][rest].sum()
        for at in range(0, len(rest), 8):
            keep = scores + left >= bar
            alive, scores = alive[keep], scores[keep]
            terms = rest[at : at + 8]
            scores = scores + postings[np.ix_(alive, terms)] @ weights[terms]
            looked += len(alive) * len(terms)
            left = left - most[q][terms].sum()
        keep = scores >= bar
        if keep.any():
            best.add(q, scores[keep], ids[alive[keep]])
    return looked


def _search(candidates: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int, scale: float) -> DataFrame:
    """Each task's k best candidates of each query of a block."""
    shared = candidates.sparkSession.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, block = shared.value
        best = Best(len(names), k)
        for batch in batches:
            for at in range(0, len(batch), SHARD_ROWS):
                search_shard(best, names, block, *_rows(batch.slice(at, SHARD_ROWS), scale))
        found = [len(s) for s in best.scores]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(names, found), pa.int64()),
                pa.array(np.concatenate([np.zeros(0, np.int64), *best.ids]), pa.int64()),
                pa.array(np.concatenate([np.zeros(0), *best.scores]).astype(np.int64), pa.int64()),
            ],
            ["query_id", "vec_id", "score"],
        )

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of each query, exactly.

    The score is the inner product of floor(scale * component); ties go to the smaller vec_id, and
    a query with fewer than k other vectors gets them all. Vectors without an id, missing ones, and
    those with a missing or non-finite component take no part. A vector that is shorter than
    another lacks its last terms, which add nothing. Where an id repeats, each of its rows is a
    candidate, and the smallest vector is the query; a query's own id is never a candidate. Without
    queries the result is empty. Scores must fit into 64 bits. Queries are broadcast in blocks of
    about QUERY_BLOCK, however many there are, and the candidates stay where they are.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    asked = vectors.where(is_query).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    asked = written(asked.where(usable & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = -(-asked.count() // QUERY_BLOCK)
    parts = []
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()  # one block
        table = mine.combine_chunks().to_batches()
        if table:
            found = _search(rows, *_rows(table[0], scale), k, scale)
            parts.append(written(found, "found") if blocks > 1 else found)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
