"""Bucketed sums, ranks and quantiles against plain pandas, with ties and a hot value."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import ordered, relational
from tabloom.plans.report import plan_text


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    n = 3000
    value = np.round(rng.exponential(10, n), 1)
    value[rng.random(n) < 0.35] = 7.0  # one value holds a third of the rows
    group = rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1])
    return pd.DataFrame({"id": np.arange(n), "g": group, "v": value, "w": rng.integers(0, 9, n)})


def test_cumulate_equals_plain_sums(spark, rows):
    df = spark.createDataFrame(rows)
    got = ordered.cumulate(df, "v", {"n": F.count("*"), "s": F.sum("w")}, by=["g"], buckets=9).toPandas()
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    want = rows.groupby(["g", "v"]).agg(n=("id", "size"), s=("w", "sum")).reset_index()
    assert (got["n"] == want["n"]).all()
    assert (got["before_s"] == want.groupby("g")["s"].cumsum() - want["s"]).all()
    assert (got["total_n"] == want.groupby("g")["n"].transform("sum")).all()
    plain = ordered.cumulate(df, "v", {"n": F.count("*"), "s": F.sum("w")}, by=["g"]).toPandas()
    pd.testing.assert_frame_equal(plain.sort_values(["g", "v"]).reset_index(drop=True)[got.columns], got, check_dtype=False)


@pytest.mark.parametrize("buckets", [None, 2, 50])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_agree_with_numpy(spark, rows, buckets, by):
    df = spark.createDataFrame(rows)
    probs = {"p0": 0.0, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p977": 0.977, "p100": 1.0}
    got = ordered.exact_quantiles(df, "v", probs, by, buckets).toPandas()
    groups = rows.groupby("g")["v"] if by else [(None, rows["v"])]
    for key, values in groups:
        line = got[got["g"] == key] if by else got
        assert line["n"].item() == len(values)
        for name, p in probs.items():
            assert line[name].item() == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_with_missing_key_and_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, None), ("b", None)], "g string, v double")
    got = {r["g"]: (r["n"], r["m"]) for r in ordered.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {"a": (2, 2.0), None: (1, 5.0)}
    assert ordered.exact_quantiles(df.limit(0), "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("buckets", [None, 3, 40])
def test_text_orders(spark, rows, buckets):
    """Texts as order, under a hot value also as tie, with missing values first."""
    texts = rows.assign(t=["Z" if v == 7.0 else None if i % 50 == 0 else f"é{v}" for i, v in zip(rows["id"], rows["v"], strict=True)], k=[f"k{i:05d}" for i in rows["id"]])
    df = spark.createDataFrame(texts[["t", "k"]])
    want = sorted(zip(texts["t"], texts["k"], strict=True), key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    got = ordered.row_positions(df, "t", "k", buckets=buckets).orderBy("position").collect()
    assert [(r["t"], r["k"]) for r in got] == want
    assert [r["position"] for r in got] == list(range(1, len(want) + 1))
    counted = ordered.cumulate(df, "t", buckets=buckets).orderBy("t").collect()
    assert sum(r["n"] for r in counted) == texts["t"].notna().sum()
    assert [r["before_n"] for r in counted] == [sum(x["n"] for x in counted[:i]) for i in range(len(counted))]


@pytest.mark.parametrize("buckets", [None, 4, 30])
def test_infinite_and_nan_values(spark, buckets):
    values = [float("inf")] * 400 + [float("-inf")] * 300 + [float("nan")] * 200 + [float(i % 37) for i in range(500)] + [None] * 50
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double").repartition(5)
    found = ordered.cumulate(df, "v", buckets=buckets).collect()
    assert sum(r["n"] for r in found) == 1400
    at = {repr(r["v"]): (r["before_n"], r["n"]) for r in found}
    assert at["-inf"] == (0, 300) and at["inf"] == (800, 400) and at["nan"] == (1200, 200)
    places = {r["id"]: r["position"] for r in ordered.row_positions(df, "v", "id", buckets=buckets).collect()}
    assert sorted(places.values()) == list(range(1, 1451))
    assert places[0] == 50 + 801 and places[400] == 51 and places[700] == 1251


def test_the_number_of_buckets_follows_the_rows(spark, monkeypatch):
    df = spark.range(30_000).withColumn("v", F.col("id") % 5000)
    assert len(ordered.cut_points(df, "v")) == 7
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 100)
    monkeypatch.setattr(ordered, "SAMPLE", 1000)
    cuts = ordered.cut_points(df, "v")
    assert 250 <= len(cuts) <= 350
    got = ordered.exact_quantiles(df, "v", {"m": 0.5, "q": 0.9}).first()
    assert (got["n"], got["m"], got["q"]) == (30_000, 2499.5, pytest.approx(4499.1))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_row_positions_with_a_hot_value(spark, rows, by):
    df = spark.createDataFrame(rows).repartition(7)
    got = ordered.row_positions(df, "v", "id", by=by, buckets=10).toPandas().sort_values("id")
    ordered_rows = rows.sort_values(["v", "id"])
    place = (ordered_rows.groupby("g").cumcount() if by else pd.Series(range(len(rows)), ordered_rows.index)) + 1
    assert (got["position"].to_numpy() == place.sort_index().to_numpy()).all()


def test_hot_value_is_spread_over_buckets(spark, rows):
    df = spark.createDataFrame(rows)
    cuts = ordered.cut_points(df, "v", 10)
    assert len(cuts) > len(set(cuts))  # the hot value repeats, which is what triggers the second cut


def test_no_single_partition_exchange_of_rows(spark, rows):
    df = spark.createDataFrame(rows)
    text = plan_text(ordered.cumulate(df, "v", by=["g"], buckets=9), "simple")
    assert "SinglePartition" not in text


def test_moving_mean_across_block_edges(spark):
    n = 100
    s = pd.Series(np.random.default_rng(1).normal(size=n))
    df = spark.createDataFrame(pd.DataFrame({"t": np.arange(n), "v": s}))
    got = relational.moving_mean(df, "t", "v", before=6, block=10).toPandas().sort_values("t")["moving_mean"]
    np.testing.assert_allclose(got.to_numpy(float), s.rolling(7).mean().to_numpy(), atol=1e-12)
    got = relational.moving_mean(df, "t", "v", 3, 3, min_periods=1, block=9).toPandas().sort_values("t")["moving_mean"]
    np.testing.assert_allclose(got.to_numpy(float), s.rolling(7, center=True, min_periods=1).mean().to_numpy(), atol=1e-12)


def test_running_mean(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(1, 50)], "t int, v double")
    got = relational.running_mean(df, "t", "v").toPandas().sort_values("t")["running_mean"]
    want = pd.Series([float(i * i) for i in range(1, 50)]).expanding().mean()
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy())


def test_window_and_join_share_one_shuffle(spark, rows):
    """With broadcasts off, the ranked rows are shuffled once: by cell, for the window and the join."""
    from tabloom.operators.sampling import rank_by_hash

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows)
        for ranked in (
            ordered.row_positions(df, "v", "id", by=["g"], buckets=10),
            rank_by_hash(df, "id", "s", by=["g"], digits=1),
        ):
            text = plan_text(ranked, "simple")
            left = text[text.index("SortMergeJoin"):]
            left = left[: left.index("Window")]  # from the join down to the rows' window
            assert "Exchange" not in left
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ten_thousand_buckets_are_planned_quickly(spark):
    """Many cuts aren't written into the plan, and the answer is that of a plain search."""
    import time

    rng = np.random.default_rng(6)
    values = [None, float("nan"), -np.inf, np.inf, *rng.normal(size=3000).tolist()]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    cuts = sorted(rng.normal(size=9999).round(3).tolist())
    start = time.time()
    placed = ordered.put_in_buckets(df, "v", cuts, "b")
    text = plan_text(placed, "simple")
    assert time.time() - start < 10 and len(text) < 100_000
    got = {repr(r["v"]): r["b"] for r in placed.collect()}
    for v in values[2:]:
        assert got[repr(v)] == np.searchsorted(cuts, v, "right")
    assert got["nan"] == len(cuts) and len(placed.where("v is not null").collect()) == 3003
    whole = ordered.cumulate(df, "v", cuts=cuts).where("v < 0").agg(F.max("before_n")).first()[0]
    assert whole == sum(v is not None and v < 0 for v in values) - 1


def test_texts_in_many_buckets(spark):
    words = [f"{a}{b}{c}" for a in "aÄz" for b in "xyü" for c in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    cuts = sorted(words, key=lambda w: w.encode())[::4]
    got = {r["w"]: r["b"] for r in ordered.put_in_buckets(df, "w", cuts, "b").collect()}
    assert all(got[w] == sum(c.encode() <= w.encode() for c in cuts) for w in words[::7])
