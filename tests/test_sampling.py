import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabloom.operators import sampling
from tabloom.operators.joins import attach_group_stats, check_relationship, common_rows, dimension_join


@pytest.fixture(scope="module")
def df(spark):
    base = spark.range(4000).withColumnRenamed("id", "k")
    return base.withColumn("g", F.when(F.col("k") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("k") % 40)))


def keys(d):
    return sorted(r[0] for r in d.select("k").collect())


@pytest.mark.parametrize("digits", [None, 1, 2, 3])
def test_sample_is_the_same_by_every_route(df, digits):
    got = keys(sampling.sample_exact(df, "k", 321, "s", digits=digits))
    assert len(got) == 321
    assert got == keys(df.orderBy(F.md5(F.concat_ws("-", "k", F.lit("s")))).limit(321))


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_sample_does_not_depend_on_partitions(df, partitions):
    assert keys(sampling.sample_exact(df.repartition(partitions), "k", 50, "p")) == keys(sampling.sample_exact(df, "k", 50, "p"))


@pytest.mark.parametrize("digits", [None, 1, 2])
def test_sample_per_group(df, digits):
    got = sampling.sample_per_group(df, "k", 30, "s", ["g"], digits=digits)
    sizes = {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}
    found = {r["g"]: r["count"] for r in got.groupBy("g").count().collect()}
    assert found == {g: min(30, n) for g, n in sizes.items()}
    assert keys(got) == keys(df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.md5(F.concat_ws("-", "k", F.lit("s")))))).where("r <= 30"))


def test_more_rows_wanted_than_there_are(df):
    assert len(keys(sampling.sample_exact(df, "k", 9999, "s", digits=2))) == 4000


@pytest.mark.parametrize("digits", [None, 2])
def test_ranks_are_a_permutation_within_groups(df, digits):
    got = sampling.rank_by_hash(df, "k", "s", "r", ["g"], digits=digits)
    bad = got.groupBy("g").agg(F.count("*").alias("n"), F.max("r").alias("top"), F.count_distinct("r").alias("d"))
    assert bad.where("n <> top or n <> d").isEmpty()


@pytest.mark.parametrize("digits", [None, 2])
def test_split_sizes(df, digits):
    out = sampling.split_train_test(df, "k", 0.2, "s", ["g"], digits=digits)
    assert out.count() == 4000
    assert out.where("is_test").count() == 800
    shares = out.groupBy("g").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert all(abs(r["t"] - 0.2 * r["n"]) < 1 for r in shares)
    plain = sampling.split_train_test(df, "k", 0.3, "s", digits=digits)
    assert plain.where("is_test").count() == 1200


def test_split_counts(df):
    out = sampling.split_counts(df, "k", 500, 1000, "s", ["g"])
    assert {r["part"]: r["count"] for r in out.groupBy("part").count().collect()} == {"train": 500, "test": 1000, "rest": 2500}
    with pytest.raises(ValueError):
        sampling.split_counts(df, "k", 3000, 1001, "s", ["g"])


def test_folds_cover_the_input(df):
    out = sampling.assign_folds(df, "k", 5, "s", ["g"])
    assert out.count() == 4000
    sizes = out.groupBy("g", "fold").count().groupBy("g").agg((F.max("count") - F.min("count")).alias("gap"))
    assert sizes.where("gap > 1").isEmpty()


def test_resample_draws_with_replacement(df):
    out = sampling.resample(df, "k", ["g"], "s")
    assert out.count() == 4000
    assert out.select("draw").distinct().count() == 4000


def test_attach_group_stats_with_a_hot_and_a_missing_group(spark, df):
    rows = df.withColumn("g", F.nullif("g", F.lit("g7")))
    stats = rows.groupBy("g").agg(F.count("*").alias("n"), F.avg("k").alias("m"))
    got = attach_group_stats(rows, ["g"], stats)
    assert got.count() == 4000
    again = got.groupBy("g").agg(F.count("*").alias("c"), F.max("n").alias("n"), F.min("n").alias("n2"))
    assert again.where("c <> n or n <> n2").isEmpty()
    assert not got.where("g is null").isEmpty()


def test_a_big_group_is_split_in_the_lookup(spark, df):
    """Without a broadcast, Spark splits the shuffled partition that holds the big group."""
    from tabloom.plans.report import plan_text

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        stats = df.groupBy("g").agg(F.count("*").alias("n"))
        got = attach_group_stats(df.repartition(16), ["g"], stats)
        assert got.where("n is null").isEmpty()
        rows = got.collect()
        assert len(rows) == 4000 and sum(r["n"] == rows[0]["n"] for r in rows) >= 1
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
        final = plan_text(got, "simple").split("== Initial Plan ==")[0]  # the text goes on with the plan as it was at first
        assert final.count("Exchange") == 2 + 1  # one for each side, and the test's own
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_join_semantics(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("z", 4)], "k string, i int")
    dim = spark.createDataFrame([("a", "x"), (None, "y")], "k string, f string")
    plain = dimension_join(left, dim, ["k"], validate="many_to_one")
    assert {(r["i"], r["f"]) for r in plain.collect()} == {(1, "x"), (2, "x"), (3, None), (4, None)}
    safe = dimension_join(left, dim, ["k"], null_safe=True)
    assert {(r["i"], r["f"]) for r in safe.collect()} == {(1, "x"), (2, "x"), (3, "y"), (4, None)}
    with pytest.raises(ValueError, match="repeat"):
        check_relationship(dim, left, ["k"], "many_to_one")
    a, b = spark.range(1000), spark.range(500, 1500)
    assert common_rows(a, b.union(b), ["id"]).count() == 500
