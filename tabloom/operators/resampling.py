"""Bootstrap and permutation tests from hashed weights."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import TWO_32, as_column, digest, poisson_one_cdf, poisson_one_weight, uniform
from ..functions.md5grid import digests
from ..session import ship_package, written
from .aggregators import Aggregator, aggregate_by, finish_states, packed_states
from .sampling import rank_by_hash

Statistic = Callable[[Column, Column], Column]
BLOCK_ROWS = 8192  # rows that a task sets against all replicates at a time
REPLICATES_HELD = 1000  # replicates whose states or rows a task holds
TABLE_ROWS = 4_000_000  # values that are sent to every task
SIGMAS = 6.0  # half the width of the band in which cut-offs are looked for


def weighted_mean(value: Column, weight: Column) -> Column:
    """The default statistic: an aggregate Column of a value and a weight."""
    return F.sum(value * weight) / F.sum(weight)


def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Slim rows that are about to be multiplied, spread over all cores whatever their files were."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def _prefix(keys: list[str], salt: str) -> Column:
    """What stands before the replicate's number in the text of a digest."""
    joined = F.concat_ws("-", *[as_column(k).cast("string") for k in keys], F.lit(salt))
    return F.concat(joined, F.lit("-")).cast("binary").alias("__prefix")


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[list[np.ndarray]]:
    """(prefixes, numbers ...) of a bounded number of rows; numbers as doubles."""
    held, n = [], 0
    for batch in batches:
        for i in range(0, len(batch), rows):
            part = batch.slice(i, rows)
            if n + len(part) > rows:
                yield _columns(held)
                held, n = [], 0
            held.append(part)
            n += len(part)
    if n:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> list:
    whole = pa.Table.from_batches(held)
    return [whole.column(0).to_pylist(), *[c.to_numpy().astype(float) for c in whole.columns[1:]]]


def _mean_replicates(known: DataFrame, keys: list[str], replicates: int, salt: str) -> DataFrame:
    """Weighted means of `__x`: each task adds up weights and weighted values of all replicates."""
    ship_package(known.sparkSession)
    cuts = np.array([c for c in (math.ceil(p * TWO_32) for p in poisson_one_cdf()) if c < 2**32], np.uint32)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = (replicates + 3) // 4
        sums, counts = np.zeros((whole, 4)), np.zeros((whole, 4))
        for prefixes, x in _blocks(batches):
            for rows, columns, words in digests(prefixes, np.arange(whole)):
                both = np.stack([np.ones(len(rows)), x[rows]])
                for part, word in enumerate(words):
                    weight, above = np.zeros(word.shape, np.uint8), np.empty(word.shape, bool)
                    for cut in cuts[:5]:
                        np.greater_equal(word, cut, out=above)
                        np.add(weight, above.view(np.uint8), out=weight)
                    if above.any():  # counts of 5 and more are rare
                        weight[above] = np.searchsorted(cuts, word[above], "right")
                    found = both @ weight.astype(float)
                    counts[columns, part] += found[0]
                    sums[columns, part] += found[1]
        at = np.flatnonzero(counts.ravel()[:replicates])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *[pa.array(a.ravel()[at]) for a in (sums, counts)]], ["replicate", "s", "n"])

    parts = known.select(_prefix(keys, salt), F.col("__x").cast("double")).mapInArrow(add_up, "replicate int, s double, n double")
    return parts.groupBy("replicate").agg((F.sum("s") / F.sum("n")).alias("estimate"))


def bootstrap_replicates(
    df: DataFrame, key, value: str, replicates: int, salt: str, statistic: Statistic = weighted_mean
) -> DataFrame:
    """(replicate, estimate): each row enters a replicate Poisson(1) times.

    A replicate that no row enters has no estimate. Four replicates read their weight off one digest. Rows are combined per replicate
    in each task, so the shuffle carries one row per task and replicate. The default statistic is summed over whole arrays.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"))
    known = _spread(known, keys)
    if statistic is weighted_mean:
        return _mean_replicates(known, keys, replicates, salt)
    blocks = F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // 4))).alias("__block")
    rows = known.select("__x", blocks, *keys)
    hexed = rows.select("__x", "__block", digest(key, F.concat_ws("-", F.lit(salt), "__block")).alias("__h"))
    four = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("__part")
    spread = hexed.select("__x", "__block", "__h", four)
    piece = F.substr(F.col("__h"), 1 + 8 * F.col("__part"), F.lit(8))
    weighted = spread.select(
        "__x",
        (F.col("__block") * 4 + F.col("__part")).alias("replicate"),
        poisson_one_weight(piece).alias("__w"),
    ).where(F.col("replicate") < replicates)
    weighted = weighted.where("__w > 0")
    return weighted.groupBy("replicate").agg(statistic(F.col("__x"), F.col("__w")).alias("estimate"))


def exact_bootstrap_replicates(df: DataFrame, key, value: str, replicates: int, salt: str) -> DataFrame:
    """(replicate, estimate): means of replicates of exactly as many draws as there are rows.

    Rows are numbered once by hash rank; draw d of replicate r takes the row numbered
    floor(u(d, r) * n). Draws are counted per row before the values are joined, so a value moves
    once for all draws of its row in a replicate.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__x"))
    numbered = written(rank_by_hash(known, keys, f"{salt}-index", "__i").select((F.col("__i") - 1).alias("__i"), "__x"), "numbered")
    n = numbered.count()
    if n <= TABLE_ROWS:
        return _mean_of_draws(numbered, n, replicates, salt)
    reps = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate")
    draws = _spread(numbered.select(F.col("__i").alias("__d")), ["__d"]).select("__d", reps)
    place = F.floor(uniform(["__d", "replicate"], salt) * n).cast("long")
    drawn = draws.select("replicate", place.alias("__i")).groupBy("replicate", "__i").agg(F.count(F.lit(1)).alias("__w"))
    return drawn.join(numbered, "__i").groupBy("replicate").agg(weighted_mean(F.col("__x"), F.col("__w")).alias("estimate"))


def _mean_of_draws(numbered: DataFrame, n: int, replicates: int, salt: str) -> DataFrame:
    """The same where the numbered values are few enough for every task: draws are looked up where they are made."""
    spark = numbered.sparkSession
    ship_package(spark)
    table = numbered.select("__i", F.col("__x").cast("double")).toArrow()
    values = np.empty(n)
    values[table["__i"].to_numpy()] = table["__x"].to_numpy()
    sent = spark.sparkContext.broadcast(values)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, sums, drawn = sent.value, np.zeros(replicates), 0
        for (prefixes,) in _blocks(batches):
            drawn += len(prefixes)
            for _, columns, words in digests(prefixes, np.arange(replicates), f"-{salt}".encode()):
                sums[columns] += x[(words[0] / TWO_32 * n).astype(np.int64)].sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(replicates, dtype=np.int32)), pa.array(sums), pa.array(np.full(replicates, float(drawn)))], ["replicate", "s", "n"]
        )

    draws = _spread(numbered.select("__i"), ["__i"]).select(F.concat(F.col("__i").cast("string"), F.lit("-")).cast("binary").alias("__prefix"))
    parts = draws.mapInArrow(add_up, "replicate int, s double, n double")
    return parts.groupBy("replicate").agg((F.sum("s") / F.sum("n")).alias("estimate")).where("estimate is not null")


def bootstrap_interval(
    df: DataFrame,
    key,
    value: str,
    replicates: int,
    salt: str,
    level: float = 0.95,
    statistic: Statistic = weighted_mean,
    exact_size: bool = False,
) -> DataFrame:
    """Percentile bootstrap interval (replicates, low, high); `exact_size` draws n of n for the mean."""
    tail = (1 - level) / 2
    if exact_size:
        estimates = exact_bootstrap_replicates(df, key, value, replicates, salt)
    else:
        estimates = bootstrap_replicates(df, key, value, replicates, salt, statistic)
    # one row per replicate, so Spark's own percentile is safe
    return estimates.agg(
        F.count("*").alias("replicates"),
        F.percentile("estimate", F.lit(tail)).alias("low"),
        F.percentile("estimate", F.lit(1 - tail)).alias("high"),
    )


def _wide(words: list[np.ndarray], at: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """A digest as two numbers of 64 bits, whose order is the order of its text."""
    a, b, c, d = (w[at].astype(np.uint64) for w in words)
    return [(a << np.uint64(32)) | b, (c << np.uint64(32)) | d]


BAND = "replicate int, low boolean, n long, s double, high_bits long, low_bits long"
SIGN = np.uint64(1 << 63)


def _banded(slim: DataFrame, low: int, high: int, numbers: np.ndarray) -> DataFrame:
    """Per replicate, count and sum of the rows whose first word lies below the band, and the rows within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(numbers), np.int64), np.zeros(len(numbers))

        def batch(k, low_, n, s, a, b):
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((k, low_, n, s, a, b), kinds, strict=True)], BAND_NAMES)

        for prefixes, x in _blocks(batches):
            for rows, columns, words in digests(prefixes, numbers):
                first = words[0]
                below = first < np.uint32(low)
                counts[columns] += below.sum(0)
                sums[columns] += x[rows] @ below.astype(float)
                i, j = np.nonzero(~below & (first <= np.uint32(high)))
                if len(i):
                    bits = [(w ^ SIGN).view(np.int64) for w in _wide(words, (i, j))]
                    yield batch(numbers[columns[j]], np.zeros(len(i), bool), np.ones(len(i), np.int64), x[rows[i]], *bits)
        zeros = np.zeros(len(numbers), np.int64)
        yield batch(numbers, np.ones(len(numbers), bool), counts, sums, zeros, zeros)

    return slim.mapInArrow(run, BAND)


BAND_NAMES = [c.split()[0] for c in BAND.split(", ")]


def _cut(group: pa.Table, n1: int) -> tuple[int, float, int, int] | None:
    """(rows, sum, two halves of the cut-off) of the n1 smallest digests of a replicate; None if the cut-off isn't in the band."""
    low = group["low"].to_numpy()
    n, s = group["n"].to_numpy(), group["s"].to_numpy()
    want = n1 - int(n[low].sum())
    if want < 1 or want > (~low).sum():
        return None
    a, b, s_in = group["high_bits"].to_numpy()[~low], group["low_bits"].to_numpy()[~low], s[~low]
    last = np.lexsort((b, a))[want - 1]
    taken = (a < a[last]) | ((a == a[last]) & (b <= b[last]))  # equal keys have equal digests
    return int(n[low].sum() + taken.sum()), float(s[low].sum() + s_in[taken].sum()), int(a[last]), int(b[last])


def _found(slim: DataFrame, total: int, n1: int, replicates: int) -> DataFrame:
    """(replicate, n, s, high_bits, low_bits): the cut-off of each replicate, and what lies at or below it.

    Digests are uniform, so the n1-th smallest is known up to some standard deviations; only rows in that band
    are compared. A replicate whose cut-off lies elsewhere is worked out again with all its rows.
    """
    out = "replicate int, n long, s double, high_bits long, low_bits long"

    def pick(group: pa.Table) -> pa.Table:
        values = [group["replicate"][0].as_py(), *(_cut(group, n1) or [None] * 4)]
        kinds = (pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], ["replicate", "n", "s", "high_bits", "low_bits"])

    share = n1 / total
    half = SIGMAS * math.sqrt(share * (1 - share) / total) + 4 / total
    low, high = max(0, int((share - half) * TWO_32)), min(2**32 - 1, int((share + half) * TWO_32))
    found = written(_banded(slim, low, high, np.arange(1, replicates + 1)).groupBy("replicate").applyInArrow(pick, out), "cutoffs")
    missed = [r[0] for r in found.where("n is null").select("replicate").collect()]
    if not missed:
        return found
    again = _banded(slim, 0, 2**32 - 1, np.array(sorted(missed))).groupBy("replicate").applyInArrow(pick, out)
    return found.where("n is not null").unionByName(again)


def _cutoffs(slim: DataFrame, total: int, n1: int, replicates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replicates and the halves of their cut-offs: as many numbers as replicates."""
    if not 0 < n1:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    found = _found(slim, total, n1, replicates).select("replicate", "high_bits", "low_bits").orderBy("replicate").toArrow()
    return tuple(found[c].to_numpy() for c in ("replicate", "high_bits", "low_bits"))


def _mean_gaps(slim: DataFrame, total: int, n1: int, replicates: int) -> DataFrame:
    """(replicate, gap) of means, from sums below the cut-off and the sum of all values."""
    if not 0 < n1:
        return slim.sparkSession.createDataFrame([], "replicate int, gap double")
    whole = slim.agg(F.sum("__x")).first()[0]
    gap = F.col("s") / F.col("n") - F.try_divide(F.lit(whole) - F.col("s"), F.lit(total) - F.col("n"))
    return _found(slim, total, n1, replicates).select("replicate", gap.alias("gap"))


def _flags(prefixes: list[bytes], cutoffs: tuple[np.ndarray, ...], some: slice) -> np.ndarray:
    """Rows by replicates: whether the row is in the first arm."""
    numbers, a, b = (c[some] for c in cutoffs)
    a, b = (c.astype(np.int64).view(np.uint64) ^ SIGN for c in (a, b))
    edge = (a >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(prefixes), len(numbers)), bool)
    for rows, columns, words in digests(prefixes, numbers):
        first = words[0] < edge[columns]
        i, j = np.nonzero(words[0] == edge[columns])
        high, low = _wide(words, (i, j))
        first[i, j] = (high < a[columns[j]]) | ((high == a[columns[j]]) & (low <= b[columns[j]]))
        out[np.ix_(rows, columns)] = first
    return out


def _arms(slim: DataFrame, cutoffs: tuple[np.ndarray, ...]) -> DataFrame:
    """(replicate, __x, __f) of all rows in all replicates, for a statistic that Spark works out."""
    sent = slim.sparkSession.sparkContext.broadcast(cutoffs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value[0].astype(np.int32)
        for prefixes, x in _blocks(batches, 512):
            for k in range(0, len(numbers), REPLICATES_HELD):
                flags = _flags(prefixes, sent.value, slice(k, k + REPLICATES_HELD))
                # a replicate's rows beside one another, so that Spark finds its sums in the cache
                columns = [np.repeat(numbers[k : k + REPLICATES_HELD], len(x)), np.tile(x, flags.shape[1]), flags.T.ravel().astype(np.int32)]
                whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["replicate", "__x", "__f"])
                yield from (whole.slice(i, 1 << 16) for i in range(0, len(whole), 1 << 16))

    return slim.mapInArrow(run, "replicate int, __x double, __f int")


def _state_gaps(slim: DataFrame, cutoffs: tuple[np.ndarray, ...], aggregator: Aggregator) -> DataFrame:
    """(replicate, gap) of an Aggregator: a task fills one state per replicate and arm from each block of its rows."""
    sent = slim.sparkSession.sparkContext.broadcast(cutoffs)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value[0]
        for prefixes, x in _blocks(batches):
            order = np.argsort(x, kind="stable")
            prefixes, x = [prefixes[i] for i in order.tolist()], x[order]
            for k in range(0, len(numbers), REPLICATES_HELD):
                flags = _flags(prefixes, sent.value, slice(k, k + REPLICATES_HELD))
                states = {}
                for j, number in enumerate(numbers[k : k + REPLICATES_HELD].tolist()):
                    for arm in (1, 0):
                        values = x[flags[:, j] == arm]
                        if len(values):
                            states[number, arm] = aggregator.update(aggregator.zero(), values, np.ones(len(values)))
                yield packed_states(states, ["replicate", "__f"])

    states = slim.mapInArrow(fill, "replicate long, __f long, state binary")
    found = finish_states(states, ["replicate", "__f"], aggregator, "s")
    one, two = (F.max(F.when(F.col("__f") == k, F.col("s"))) for k in (1, 0))
    return found.groupBy("replicate").agg((one - two).alias("gap"))


def permutation_test(
    df: DataFrame,
    key,
    value: str,
    first: Column,
    replicates: int,
    salt: str,
    statistic: Statistic | Aggregator = weighted_mean,
) -> DataFrame:
    """Two-sided permutation test of a difference between two arms.

    In each replicate the rows with the n1 smallest digests form the first arm, so its
    size is exact; the digest that bounds them comes from counts per digest prefix.
    p is twice the smaller one-sided p, each counting the observed split. The statistic is an
    aggregate Column of a value and a weight, or an Aggregator with a mergeable state.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("__x"), first.cast("int").alias("__first")
    )

    rows = written(_spread(rows, keys), "rows")
    total = rows.count()
    by_column = callable(statistic)

    def gaps_of(arms: DataFrame) -> DataFrame:
        """(replicate, gap) of rows with replicate, __x and __f, which is 1 in the first arm."""
        if by_column:
            gap = statistic(F.col("__x"), F.col("__f")) - statistic(F.col("__x"), 1 - F.col("__f"))
            return arms.groupBy("replicate").agg(gap.alias("gap"))
        found = aggregate_by(arms.withColumn("__w", F.lit(1)), ["replicate", "__f"], "__x", "__w", statistic, "s")
        one, two = (F.max(F.when(F.col("__f") == k, F.col("s"))) for k in (1, 0))
        return found.groupBy("replicate").agg((one - two).alias("gap"))

    observed = gaps_of(rows.select(F.lit(0).alias("replicate"), "__x", F.col("__first").alias("__f")))
    seen = observed.select("gap").scalar()
    n1 = rows.agg(F.sum("__first")).first()[0] or 0
    slim = rows.select(_prefix(keys, salt), F.col("__x").cast("double").alias("__x"))
    ship_package(rows.sparkSession)
    if statistic is weighted_mean:
        gaps = _mean_gaps(slim, total, n1, replicates)
    elif by_column:
        gaps = gaps_of(_arms(slim, _cutoffs(slim, total, n1, replicates)))
    else:
        gaps = _state_gaps(slim, _cutoffs(slim, total, n1, replicates), statistic)
    slack = 1e-14 * F.abs(seen)
    counts = gaps.agg(
        F.count("*").alias("replicates"),
        F.count_if(F.col("gap") <= seen + slack).alias("lower"),
        F.count_if(F.col("gap") >= seen - slack).alias("upper"),
    )
    one_sided = (F.least("lower", "upper") + 1) / (F.col("replicates") + 1)
    return counts.select(
        seen.alias("observed"), "replicates", "lower", "upper", F.least(F.lit(1.0), 2 * one_sided).alias("p")
    )
