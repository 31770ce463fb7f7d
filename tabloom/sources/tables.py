"""Parquet: scans, drifting schemas, partitioned datasets, generate-once tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import nan_to_null
from ..session import scratch_path


def scan(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Parquet scan (a path, several, or a glob). A missing path is an error.

    `columns` prunes the read; the schema is checked rather than guessed when given.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def nan_as_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN to NULL in float columns.

    A step of its own, not part of the scan: a filter above a rewritten column
    can't be pushed down to the file, so only columns that hold NaN should pay.
    """
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    wanted = [c for c in (columns or floats) if c in floats]
    return df.withColumns({c: nan_to_null(c) for c in wanted})


NANOS = "spark.sql.legacy.parquet.nanosAsLong"  # else a file with nanoseconds can't be read


def scan_with_drift(
    spark: SparkSession, paths: Sequence[str], casts: Mapping[str, str]
) -> DataFrame:
    """Union of datasets whose schemas differ: cast the drifting columns of each, then union.

    Columns that some datasets lack are filled with NULL. A column that some file holds in whole
    numbers and `casts` wants as a timestamp is nanoseconds since 1970, cut to microseconds.
    """
    before = spark.conf.get(NANOS, "false")
    spark.conf.set(NANOS, "true")  # read when the relation is resolved
    try:
        parts = [scan(spark, path) for path in paths]
    finally:
        spark.conf.set(NANOS, before)
    out = None
    for part in parts:
        present = {c: _recast(part, c, t) for c, t in casts.items() if c in part.columns}
        part = part.withColumns(present)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no datasets to read")
    return out


def _recast(df: DataFrame, column: str, kind: str) -> Column:
    if kind.startswith("timestamp") and df.schema[column].dataType.typeName() == "long":
        micros = F.timestamp_micros(F.floor(F.col(column) / F.lit(1000)).cast("long"))
        # a stored instant has no zone: what is wanted is its UTC wall clock
        return F.to_utc_timestamp(micros, F.lit("UTC")).cast(kind)
    return F.col(column).cast(kind)


def scan_tagged(spark: SparkSession, path: str, name: str, pattern: str) -> DataFrame:
    """Scan files below a folder and tag each row with a piece of its file's path."""
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    return df.select("*", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias(name))


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """Hive-style dataset, one folder per value.

    Rows are rebalanced by value: Spark splits a value that is too large for one task over as many
    tasks as its size asks for, and puts small values together.
    """
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)


def write_filtered(df: DataFrame, condition: Column, path: str) -> DataFrame:
    """Filter and sink in one pass; returns (rows, bytes) of what was written."""
    spark = df.sparkSession
    df.where(condition).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.withColumn("bytes", folder_bytes(spark, path).scalar())


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of the data files below a path, read from file listings only."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("length")
    )
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def csv_parquet_ratio(df: DataFrame) -> DataFrame:
    """Write the same rows as CSV and as Parquet and compare the bytes."""
    spark = df.sparkSession
    csv, parquet = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    df.write.option("header", True).csv(csv)
    df.write.parquet(parquet)
    sizes = folder_bytes(spark, csv).withColumnRenamed("bytes", "csv_bytes")
    sizes = sizes.withColumn("parquet_bytes", folder_bytes(spark, parquet).scalar())
    return sizes.withColumn("ratio", F.col("csv_bytes") / F.col("parquet_bytes"))


def generate_once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at `path`; build and write it first if it isn't there yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not files.exists(done):
        # overwrite, so that a half-written table of a lost job is replaced
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def arrow_schema(df: DataFrame) -> list[tuple[str, str, str]]:
    """(column, Spark type, Arrow type) of a table, without reading any row."""
    from pyspark.sql.pandas.types import to_arrow_type

    return [
        (f.name, f.dataType.simpleString(), str(to_arrow_type(f.dataType)))
        for f in df.schema.fields
    ]


def small_to_arrow(df: DataFrame, max_rows: int = 100_000):
    """Hand a small final table to Arrow; refuses (rather than cuts) a larger one."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate before handing the table over")
    return table
