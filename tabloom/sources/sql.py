"""SQL over tables: bound values and frames referred to by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def sql_over(
    spark: SparkSession,
    text: str,
    frames: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run SQL; `{name}` stands for a frame and `:name` for a bound value.

    Values are never spliced into the text, so they can't change the query.
    """
    return spark.sql(text, args=dict(values or {}), **dict(frames or {}))
