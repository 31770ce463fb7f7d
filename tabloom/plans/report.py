"""What the optimizer pushed into the scans, read from the plan text."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def plan_report(df: DataFrame) -> dict[str, list[str]]:
    """Pushed filters, partition filters, columns read and exchanges of a plan."""
    text = plan_text(df)

    def lines(name: str) -> list[str]:
        return [m.strip() for m in re.findall(rf"^{name}: (.*)$", text, flags=re.M)]

    return {
        "pushed_filters": lines("PushedFilters"),
        "partition_filters": lines("PartitionFilters"),
        "read_schema": lines("ReadSchema"),
        "exchanges": re.findall(r"^\(\d+\) (Exchange|BroadcastExchange)", text, flags=re.M),
        "single_partition": re.findall(r"SinglePartition", text),
    }
