"""A corpus pipeline of five stages, each an operator over all rows that the one before kept.

Awkward rows go through all stages as their operators state it: a missing or empty text is scored as
such, is a copy of other empty texts, is near to nothing, has no words to mix, so that only whole
copies of it are taken, and has no tokens. Rows without an id are kept apart by their text; of
repeated rows one stays. Very long texts are taken whole, extra columns are carried along to the
stage before the last, and an empty table passes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import exact, mixing, neardup, quality, queries
from tabloom.session import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones that aren't held out.

    Without labels of both kinds every score is 0.5, and all documents are accepted.
    """
    ranker = quality.fit(docs, queries.table(spark, sf_dir, "labels"))
    return quality.classify(docs, ranker).where("predicted = 1").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return exact.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (runs of five words, similarity 0.8): that with the smallest id."""
    return neardup.keep_one(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as its source's target weight asks."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document of the mix."""
    return queries.token_digests(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
