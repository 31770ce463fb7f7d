"""CSV dialects, encodings and JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import decimal_comma, is_mojibake, parse_int


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    """CSV with a header; NULL becomes an empty field and an empty text becomes ""."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Typed CSV read: a field that doesn't fit its type stops the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_european(
    spark: SparkSession, path: str, kinds: Mapping[str, str], sep: str = ";"
) -> DataFrame:
    """';' CSV with decimal commas. `kinds` maps each column to 'text', 'int' or 'decimal'."""
    raw = read_csv(spark, path, ", ".join(f"`{c}` string" for c in kinds), sep=sep)
    make = {"text": F.col, "int": parse_int, "decimal": decimal_comma}
    return raw.select(*[make[kind](c).alias(c) for c, kind in kinds.items()])


def write_european(df: DataFrame, path: str, sep: str = ";") -> None:
    """Write doubles with a decimal comma and ';' between fields."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    shown = [
        F.translate(F.col(c).cast("string"), ".", ",").alias(c) if c in doubles else F.col(c)
        for c in df.columns
    ]
    write_csv(df.select(*shown), path, sep=sep)


def mojibake_report(df: DataFrame, column: str) -> DataFrame:
    """Rows, and rows whose text was read with the wrong one-byte codec."""
    return df.agg(
        F.count("*").alias("rows"), F.count_if(is_mojibake(column)).alias("mojibake_rows")
    )


def json_text(value: Column) -> Column:
    """A struct as JSON text; non-ASCII text is kept as it is."""
    return F.to_json(value)


def json_value(text: Column | str, schema: StructType | str) -> Column:
    return F.from_json(text, schema)
