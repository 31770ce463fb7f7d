"""Streams that run over everything available and stop, with repeatable sinks.

Every sink writes a micro-batch to a folder named by its batch number, overwriting it,
so a batch that is retried after a lost executor leaves the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..operators.inference import base_edges, bin_number, psi_from_counts
from ..operators.quality import Contract, split_marked, with_reasons
from ..session import scratch_path


def open_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """File stream over a folder or a glob of Parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    """A watermark needs a zoned timestamp: the zone-less one is read as UTC session time."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def _run(df: DataFrame, mode: str, write: Callable[[DataFrame, int], None], label: str) -> None:
    checkpoint = scratch_path(df.sparkSession, f"{label}-checkpoint")
    run = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    run.awaitTermination()


def run_to_table(df: DataFrame, mode: str, label: str) -> tuple[str, DataFrame]:
    """Run a stream into per-batch folders; returns the path and the rows with their batch number."""
    spark = df.sparkSession
    path = scratch_path(spark, label)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    _run(df, mode, write, label)
    schema = StructType(df.schema.fields).add("batch", IntegerType())
    return path, spark.read.schema(schema).parquet(path)


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last emitted state of each key of an update-mode sink."""
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__v"))
    return last.select(*keys, "__v.*")


def windowed(
    stream: DataFrame, ts: str, lateness: str, length: str, slide: str | None = None, **aggregates: Column
) -> DataFrame:
    """Tumbling or sliding event-time windows with late data: (start, end, aggregates)."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = event_time(stream, ts, lateness).groupBy(span.alias("w"))
    out = grouped.agg(*[c.alias(n) for n, c in aggregates.items()])
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *aggregates)


def windowed_run(stream: DataFrame, ts: str, lateness: str, length: str, slide: str | None = None, **aggregates: Column) -> DataFrame:
    """Run `windowed` over everything available and return the final windows."""
    out = windowed(stream, ts, lateness, length, slide, **aggregates)
    _, rows = run_to_table(out, "update", "windows")
    return latest(rows, ["start", "end"])


def contract_run(stream: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Check a stream against a contract; returns (valid rows, quarantined rows with reasons).

    Each micro-batch is marked with the row checks it breaks and written. Whether a key repeats is
    only known over all batches, so keys are counted over what was written, and the result is that
    of `quarantine` on the whole table.
    """
    contract.check_schema(stream)
    spark = stream.sparkSession
    path = scratch_path(spark, "marked")

    def write(batch: DataFrame, number: int) -> None:
        with_reasons(batch, contract).write.mode("overwrite").parquet(f"{path}/batch={number}")

    _run(stream, "append", write, "contract")
    marked = StructType(stream.schema.fields).add("reasons", ArrayType(StringType()))
    rows = spark.read.schema(marked).parquet(path).select(*marked.names)  # without the batch number
    return split_marked(rows, contract)


def dedupe_run(stream: DataFrame, keys: Sequence[str], ts: str, lateness: str) -> DataFrame:
    """Drop repeats of a key that arrive within the lateness of each other."""
    timed = event_time(stream, ts, lateness)
    _, rows = run_to_table(timed.dropDuplicatesWithinWatermark(list(keys)), "append", "distinct")
    return rows.drop("batch")


def drift_run(
    stream: DataFrame, base: DataFrame, value: str, ts: str, lateness: str, length: str, bins: int = 10
) -> DataFrame:
    """Stability index of each window against a fixed base: (start, end, n_new, psi)."""
    edges = base_edges(base, value, bins).first()[0]  # bins + 1 numbers
    number = bin_number(F.col(value), [F.lit(e) for e in edges], bins)
    shares = base.groupBy(number.alias("bin")).agg(F.count("*").alias("base"))  # bins + 1 rows
    timed = event_time(stream, ts, lateness).withColumn("bin", F.coalesce(number, F.lit(-1)))
    counts = timed.groupBy(F.window(ts, length).alias("w"), "bin").agg(F.count("*").alias("new"))
    counts = counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "bin", "new")
    _, rows = run_to_table(counts, "update", "drift")
    found = latest(rows, ["start", "end", "bin"])
    # every window meets the base's few bins, seen or not
    every = shares.select(F.collect_list(F.struct(F.coalesce("bin", F.lit(-1)).alias("bin"), "base")).alias("cells"))
    cells = found.select("start", "end").distinct().withColumn("cells", every.scalar())
    cells = cells.select("start", "end", F.inline("cells"))
    both = cells.join(found, ["start", "end", "bin"], "full").fillna(0, ["base", "new"])
    return psi_from_counts(both, bins, ["start", "end"]).select("start", "end", "n_new", "psi")
