"""Merged sketches against exact answers, within their stated errors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import sketches
from tabloom.session import written


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(4)
    day = rng.choice(30, 60_000, p=np.r_[0.4, np.full(29, 0.6 / 29)])
    rows = [(int(d), float(x), int(u), f"s{u % 7}") for d, x, u in zip(day, rng.lognormal(size=60_000), rng.integers(0, 25_000, 60_000), strict=True)]
    rows += [(1, None, None, None), (1, float("nan"), 3, None)]
    return spark.createDataFrame(rows, "day int, x double, u long, s string").cache()


@pytest.fixture(scope="module")
def stored(df):
    return written(sketches.sketch_table(df, ["day"], ["x"], {"user": ["u"], "pair": ["u", "s"]}), "sketches")


@pytest.mark.parametrize("days", ["day < 30", "day < 5", "day = 0", "day % 2 = 1"])
def test_quantiles_of_any_slices(df, stored, days):
    probs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.99}
    found = sketches.merged_quantiles(stored.where(days), "x", probs).first()
    values = np.sort([r["x"] for r in df.where(days).where("x is not null and not isnan(x)").collect()])
    assert found["n"] == len(values)
    for name, p in probs.items():
        low, high = np.searchsorted(values, found[name], "left") / len(values), np.searchsorted(values, found[name], "right") / len(values)
        assert low - sketches.rank_error() <= p <= high + sketches.rank_error()
    rank = sketches.merged_rank(stored.where(days), "x", 1.0).first()["rank"]
    assert rank == pytest.approx((values <= 1.0).mean(), abs=sketches.rank_error())


def test_quantiles_per_group_and_without_values(spark, df, stored):
    found = sketches.merged_quantiles(stored.withColumn("half", F.col("day") % 2), "x", {"m": 0.5}, ["half"]).collect()
    assert {r["half"] for r in found} == {0, 1} and sum(r["n"] for r in found) == 60_000
    none = sketches.sketch_table(df.limit(3).withColumn("x", F.lit(None).cast("double")), ["day"], ["x"])
    assert all(r["m"] is None and r["n"] == 0 for r in sketches.merged_quantiles(none, "x", {"m": 0.5}, ["day"]).collect())


@pytest.mark.parametrize("days", ["day < 30", "day < 3", "day = 7"])
def test_distinct_counts_of_any_slices(df, stored, days):
    found = sketches.merged_distinct(stored.where(days), ["user", "pair"]).first()
    exact = df.where(days).agg(F.count_distinct("u").alias("user"), F.count_distinct("u", "s").alias("pair")).first()
    for key in ("user", "pair"):
        assert found[key] == pytest.approx(exact[key], rel=sketches.distinct_error())


def test_unmatched_keys(df, stored):
    left, right = stored.where("day < 15"), stored.where("day >= 15")
    found = sketches.unmatched_keys(left, right, "user").first()
    a, b = ({r["u"] for r in df.where(c).where("u is not null").collect()} for c in ("day < 15", "day >= 15"))
    slack = sketches.theta_error() * len(a | b)
    assert found["left_keys"] == pytest.approx(len(a), abs=slack) and found["unmatched"] == pytest.approx(len(a - b), abs=slack)
    assert sketches.unmatched_keys(left, left, "user").first()["unmatched"] == 0


def test_parts_of_a_key_stay_apart(spark):
    df = spark.createDataFrame([("1", "1:2"), ("11", ":2"), ("1:1", "2")], "a string, b string")
    assert sketches.sketch_table(df, [], [], {"k": ["a", "b"]}).select(F.hll_sketch_estimate("hll_k")).first()[0] == 3
