"""Trailing means on a stream equal those of the whole table, however it arrives."""

import datetime
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.plans.catalog import streams
from tabloom.plans.registry import Tables
from tabloom.streaming import runs, state

SCHEMA = "u long, ts timestamp_ntz, id long, v double"
START = datetime.datetime(2024, 1, 1)


def events(n=240, seed=1):
    rng, rows = random.Random(seed), []
    for i in range(n):
        minute = i + rng.randint(0, 3)  # ties in time, too
        rows.append((rng.randint(0, 4), START + datetime.timedelta(minutes=minute), i, None if i % 23 == 0 else float(rng.randint(0, 50))))
    return rows


def arrival(rows, seed=2):
    """Up to half an hour late, so earlier events come after later ones."""
    rng = random.Random(seed)
    return sorted(rows, key=lambda r: r[1] + datetime.timedelta(minutes=rng.randint(0, 30)))


MARK = (-1, START + datetime.timedelta(days=5), -1, None)


def write(spark, rows, path, parts):
    """One file after the other, as a file stream reads them by time."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def want(rows, n):
    out = {}
    df = pd.DataFrame(rows, columns=["u", "ts", "id", "v"]).sort_values(["u", "ts", "id"])
    for _, part in df.groupby("u"):
        means = part["v"].rolling(n, min_periods=n).mean()
        out |= {int(i): None if m != m else pytest.approx(m) for i, m in zip(part["id"], means, strict=True)}
    return out


def collect(rows):
    found = [r for r in rows.where("u >= 0").collect()]
    out = {r["id"]: r["mean"] for r in found}
    assert len(out) == len(found)  # each event once
    return out


def means(spark, path, **options):
    stream = runs.open_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    return state.trailing_means(stream, "u", "ts", "id", "v", 4, "40 minutes", **options)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_any_split_into_batches_gives_the_means_of_the_table(spark, tmp_path, parts):
    rows = events()
    path = str(tmp_path / "in")
    write(spark, arrival(rows), path, parts)
    write(spark, [MARK], path, 1)
    _, out = runs.run_to_table(means(spark, path), "append", "means")
    assert collect(out) == want(rows, 4)


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    rows = arrival(events(seed=4))
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        query = means(spark, path).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "point"))
        query.option("path", out).trigger(availableNow=True).start().awaitTermination()

    write(spark, rows[:120], path, 2)
    run()
    first = spark.read.parquet(out).count()
    assert 0 < first < 120  # what the watermark hasn't passed still waits
    write(spark, [*rows[120:]], path, 2)
    write(spark, [MARK], path, 1)
    run()
    assert collect(spark.read.parquet(out)) == want(rows, 4)


def test_a_key_that_rests_for_long_starts_anew(spark, tmp_path):
    at = lambda minutes: START + datetime.timedelta(minutes=minutes)
    rows = [(1, at(m), m, float(m)) for m in (0, 1, 2, 3, 4)] + [(1, at(m), m, float(m)) for m in (600, 601, 602, 603)]
    rows += [(2, at(m), 1000 + m, 1.0) for m in range(0, 700, 100)]
    path = str(tmp_path / "in")
    write(spark, sorted(rows, key=lambda r: r[1]), path, 4)
    write(spark, [MARK], path, 1)
    _, out = runs.run_to_table(means(spark, path, forget_ms=3_600_000 * 3), "append", "means")
    got = collect(out)
    assert got[3] == 1.5 and got[4] == 2.5 and got[600] is got[601] is got[602] is None and got[603] == 601.5
    assert got[1300] == 1.0 and got[1200] is None  # pauses below the limit don't matter


def test_rows_without_a_key_or_time_are_left_out(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(None, START, 1, 1.0), (1, None, 2, 1.0), (1, START, 3, 1.0), MARK]
    write(spark, rows, path, 1)
    write(spark, [(-1, MARK[1] + datetime.timedelta(days=1), -2, None)], path, 1)
    _, out = runs.run_to_table(means(spark, path), "append", "means")
    assert {r["id"] for r in out.where(F.col("u") >= 0).collect()} == {3}


def test_batches_grow_with_the_table_and_not_in_number(spark, folder):
    events = Tables(spark, folder).events.repartition(12)
    t = SimpleNamespace(spark=spark, events=events)
    _, rows = runs.run_to_table(streams.stream(t), "append", "rows")
    assert rows.select("batch").distinct().count() <= streams.BATCHES
    # however the files fall into batches, none of their rows is late
    assert streams.r1(t).agg(F.sum("n")).first()[0] == events.count() == rows.count()
