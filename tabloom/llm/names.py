"""Names for columns that an operator adds for its own use."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores added until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
