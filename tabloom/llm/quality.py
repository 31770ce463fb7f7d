"""Quality classifier by Bradley-Terry pairwise ranking.

Preference pairs set a good document against a bad one. Logistic loss on the difference of their
features gives the weights of a linear score; a quantile of the labelled scores is the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ..operators.ordered import exact_quantiles, row_positions
from ..session import ship_package, written
from .textbytes import U64, Words, mix, slices

MIN_PAIRS = 40_000  # preference pairs of the fit; more if a side has more documents
PAIRS_PER_TASK = 50_000
FEATURES = [
    "upper", "symbols", "bars", "digits", "doubled", "stops", "high_bytes", "symbol_ends", "upper_words",
    "repeated_words", "distinct_words", "distinct_pairs", "log_words", "word_bytes", "long_words", "lines",
]


def _is(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


UPPER, LOWER, DIGIT = _is((65, 90)), _is((97, 122)), _is((48, 57))
STOP = _is((44, 44), (46, 46))  # , .
SYMBOL = _is((33, 47), (58, 64), (91, 96), (123, 126)) & ~STOP
HIGH = _is((128, 255))


def _distinct(text: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each text."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return np.bincount(text[new], minlength=n)


def measure(texts: pa.Array) -> np.ndarray:
    """The features of a batch of texts, one row each: shares of its bytes, words and word pairs."""
    w = Words(texts)
    n, data = w.texts, w.bytes
    size = np.maximum(np.diff(w.offsets), 1)
    words = np.maximum(w.counts, 1)

    def per_byte(hit: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(hit)])
        return (sums[w.offsets[1:]] - sums[w.offsets[:-1]]) / size

    def per_word(hit: np.ndarray) -> np.ndarray:
        return np.bincount(w.text, weights=hit, minlength=n) / words

    symbol = SYMBOL[data]
    doubled = np.zeros(len(data), bool)
    doubled[1:] = symbol[1:] & (data[1:] == data[:-1])
    last = data[np.maximum(w.ends - 1, 0)]
    capital = np.concatenate([[0], np.cumsum(UPPER[data])])
    small = np.concatenate([[0], np.cumsum(LOWER[data])])
    lengths = w.ends - w.starts
    shout = (capital[w.ends] - capital[w.starts] > 1) & (small[w.ends] == small[w.starts])
    together = w.text[1:] == w.text[:-1]
    again = np.zeros(len(w.text))
    again[1:] = together & (w.hashes[1:] == w.hashes[:-1])
    pair = mix(w.hashes[:-1] * U64(3) + w.hashes[1:])[together]
    pairs = _distinct(w.text[1:][together], pair, n) / np.maximum(w.counts - 1, 1)
    pairs[w.counts < 2] = 1.0
    distinct = np.where(w.counts > 0, _distinct(w.text, w.hashes, n) / words, 1.0)
    columns = [
        per_byte(UPPER[data]), per_byte(symbol), per_byte(data == ord("|")), per_byte(DIGIT[data]), per_byte(doubled),
        per_byte(STOP[data]), per_byte(HIGH[data]), per_word(SYMBOL[last]), per_word(shout),
        per_word(again), distinct, pairs, np.log1p(w.counts), per_word(lengths) / 10,
        per_word(lengths > 25), per_byte(data == 10),
    ]
    return np.column_stack(columns)


def with_features(docs: DataFrame, name: str = "__features") -> DataFrame:
    """All columns, and the features of `text` as array<double>. A missing text is empty."""
    ship_package(docs.sparkSession)
    keep = docs.columns
    schema = StructType([*docs.schema.fields]).add(name, ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                found = measure(batch.column(batch.schema.get_field_index("text")))
                ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * found.shape[1])
                made = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, made], [*keep, name])

    return docs.mapInArrow(run, schema)


@dataclass
class Ranker:
    """Weights of the standardised features, and the score of the threshold."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float

    def raw(self, features: Column) -> Column:
        terms = [
            (features[i] - F.lit(m)) * F.lit(w / s)
            for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weights, strict=True))
        ]
        total = F.lit(0.0)
        for t in terms:
            total = total + t
        return total

    def score(self, features: Column) -> Column:
        """0 to 1; 0.5 at the threshold."""
        return 1 / (1 + F.exp(F.lit(self.threshold) - self.raw(features)))


def is_held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, f): the features of every row, written. From here on no text is read or moved."""
    return written(with_features(docs.select("doc_id", "text")).select("doc_id", F.col("__features").alias("f")), "measured")


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, features) of all labelled documents that aren't held out, from texts or what `measured` gives.

    Missing labels don't count, nor do ids whose labels disagree. Only ids, labels and features are shuffled.
    """
    rows = measured(docs) if "text" in docs.columns else docs
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~is_held_out())
    agreed = known.groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi")
    chosen = agreed.select("doc_id", F.col("lo").alias("quality")).hint("merge")  # one route for all sizes
    learned = rows.where("doc_id is not null").where(~is_held_out()).join(chosen, "doc_id")
    return written(learned.select("doc_id", "quality", "f"), "training")


def preference_pairs(rows: DataFrame, min_pairs: int = MIN_PAIRS) -> DataFrame:
    """(f): features of a good document minus those of a bad one.

    Both sides are put in the order of a hash. Each document of the larger side meets the one of its place
    on the other side, which starts again at its end, so every document is in a pair; if these are fewer than
    `min_pairs`, it meets others drawn by hash, too.
    """
    placed = row_positions(rows.withColumn("hash", F.xxhash64("doc_id")), "hash", "doc_id", "place", ["quality"])
    placed = written(placed.select("quality", "f", (F.col("place") - 1).alias("place")), "placed")
    counts = {r["quality"]: r["count"] for r in placed.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return rows.select("f").limit(0)
    large = max(counts, key=lambda k: (counts[k], k))
    each, n = max(1, min_pairs // counts[large]), counts[1 - large]
    dealt = placed.where(F.col("quality") == large).select(F.col("f").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("i"), "place")
    other = F.when(F.col("i") == 0, F.col("place") % n).otherwise(F.pmod(F.xxhash64("place", "i"), F.lit(n)))
    met = dealt.withColumn("other", other).join(
        placed.where(F.col("quality") != large).select(F.col("f").alias("b"), F.col("place").alias("other")), "other"
    )
    sign = 1.0 if large == 1 else -1.0
    return met.select(F.zip_with("a", "b", lambda x, y: (x - y) * sign).alias("f"))


def fit(docs: DataFrame, labels: DataFrame, min_pairs: int = MIN_PAIRS) -> Ranker:
    """Learn the ranking and its threshold from all labelled documents that aren't held out.

    `docs` holds texts, or the features that `measured` found for them. The threshold is the quantile of the labelled scores at the share of bad labels. Without labels
    of both kinds there is nothing to rank (an empty table, too): all weights are 0 and every score
    is 0.5. Documents whose labels differ, missing labels and ids aren't learned from. Missing and
    empty texts are learned from as they are scored. Equal documents on both sides differ by nothing.
    """
    rows = training_rows(docs, labels)
    size = len(FEATURES)
    total, bad, *moments = rows.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("quality") == 0),
        *[F.avg(F.col("f")[i]) for i in range(size)],
        *[F.stddev_pop(F.col("f")[i]) for i in range(size)],
    ).first()
    if not bad or bad == total:
        return Ranker([0.0] * size, [1.0] * size, [0.0] * size, 0.0)
    mean, scale = moments[:size], [s or 1.0 for s in moments[size:]]
    differences = written(preference_pairs(rows, min_pairs), "pairs")
    differences = differences.coalesce(max(8, total // PAIRS_PER_TASK))
    scaled = F.transform("f", lambda x, i: x / F.get(F.array(*[F.lit(s) for s in scale]), i))
    # a preference counts in both directions, so that the loss has two classes and no intercept
    sign = F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("sign")
    both = differences.select(scaled.alias("d"), sign)
    both = both.select(array_to_vector(F.transform("d", lambda x: x * F.col("sign"))).alias("x"), (F.col("sign") > 0).cast("double").alias("y"))
    model = LogisticRegression(
        featuresCol="x", labelCol="y", fitIntercept=False, standardization=False, regParam=1e-4, maxIter=60
    ).fit(both.persist())
    both.unpersist()
    ranker = Ranker(mean, scale, [float(w) for w in model.coefficients], 0.0)
    share = bad / total
    scores = rows.select(ranker.raw(F.col("f")).alias("raw"))
    ranker.threshold = float(exact_quantiles(scores, "raw", {"cut": share}).first()["cut"])
    return ranker


def classify(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """All columns of `docs`, and score and predicted (1 from 0.5 on; columns of these names are replaced).

    Each row is scored on its own whole text, however long, so repeated rows and ties get equal
    scores. A missing or empty text has all shares 0 and gets the score of that. An empty table
    stays empty. A column called __features is taken for the operator's own: don't hand one in.
    """
    docs = docs.drop("score", "predicted")
    return _scored(with_features(docs), ranker, "__features")


def classify_measured(rows: DataFrame, ranker: Ranker) -> DataFrame:
    """(doc_id, score, predicted) from what `measured` gives: the scores of `classify`, without reading a text again."""
    return _scored(rows, ranker, "f")


def _scored(rows: DataFrame, ranker: Ranker, features: str) -> DataFrame:
    scored = rows.withColumn("score", ranker.score(F.col(features))).drop(features)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
