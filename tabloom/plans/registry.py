"""Named queries over the standard tables, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Tables:
    """The standard tables of one folder, read when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# ---- pieces of check SQL -----------------------------------------------------------
def md5_sql(salt: str, *keys: str) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5(concat_ws('-', {parts}, '{salt}'))"


def hex_uniform_sql(hexed: str, part: int = 0) -> str:
    return f"(CAST('0x' || substr({hexed}, {1 + 8 * part}, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def uniform_sql(salt: str, *keys: str) -> str:
    return hex_uniform_sql(md5_sql(salt, *keys))


def open_uniform_sql(salt: str, *keys: str) -> str:
    return f"({uniform_sql(salt, *keys)} + 0.5 / CAST(4294967296 AS DOUBLE))"


def load_all() -> None:
    from . import catalog

    catalog.load()
