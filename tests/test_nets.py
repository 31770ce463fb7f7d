"""The minibatch net: gradients, partitions, the curve per epoch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.models import nets, prepare


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(0)
    shape = nets.Shape((4, 6, 5, 3))
    w, x, y = shape.start(1), rng.normal(size=(20, 4)), rng.integers(0, 3, 20)
    grad, loss = shape.gradient(w, x, y)
    assert len(grad) == len(shape) == 4 * 6 + 6 + 6 * 5 + 5 + 5 * 3 + 3
    assert loss == pytest.approx(-np.log(shape.probabilities(w, x)[np.arange(20), y]).sum())
    for k in range(len(shape)):
        up, down = w.copy(), w.copy()
        up[k] += 1e-6
        down[k] -= 1e-6
        assert (shape.gradient(up, x, y)[1] - shape.gradient(down, x, y)[1]) / 2e-6 == pytest.approx(grad[k], abs=1e-4)


@pytest.fixture(scope="module")
def ready(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2))
    rows = [(i, float(a), float(b), int(a * b > 0) + int(a > 1)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, k int")
    return prepare.columns_to_features(["a", "b"]).fit(df).transform(df).cache()


def net(**options):
    return nets.Net("k", "features", "id", 3, hidden=(16, 8), rate=0.02, **options)


def test_sums_don_t_depend_on_partitions(ready):
    shape = nets.Shape((2, 5, 3))
    from pyspark.ml.functions import vector_to_array

    rows = ready.select(vector_to_array("features").alias("x"), F.col("k").alias("y"))
    one, many = (nets.gradient_sums(rows.repartition(n), shape, shape.start(3)) for n in (1, 13))
    assert one.keys() == many.keys() and one[nets.ROWS] == 600
    assert [one[k] for k in sorted(one)] == pytest.approx([many[k] for k in sorted(one)])


def test_the_same_weights_at_two_partitionings_and_one_row_per_epoch(ready):
    a = net(epochs=3, batch=100, deal_every=2).fit(ready.repartition(1))
    b = net(epochs=3, batch=100, deal_every=2).fit(ready.repartition(7))
    assert np.allclose(a.curve, b.curve) and len(a.curve) == 3
    rows = a.accuracies(ready, "k").orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == [1, 2, 3] and {r["rows"] for r in rows} == {600}
    last = a.transform(ready).agg(F.avg((F.col("prediction") == F.col("k")).cast("double"))).first()[0]
    assert rows[-1]["accuracy"] == pytest.approx(last)


def test_it_learns_what_no_line_can(ready):
    fitted = net(epochs=12, batch=60, deal_every=6).fit(ready)
    assert fitted.losses[-1] < 0.6 * fitted.losses[0]
    assert fitted.accuracies(ready, "k").where("epoch = 12").first()["accuracy"] > 0.85


def test_no_rows_and_rows_without_a_label(ready):
    with pytest.raises(ValueError):
        net().fit(ready.limit(0))
    some = ready.withColumn("k", F.when(F.col("id") < 50, F.col("k")))
    fitted = net(epochs=1, batch=4).fit(some)  # some batches may be empty
    assert fitted.transform(ready.limit(0)).count() == 0 and fitted.accuracies(ready.limit(0), "k").count() == 0


def test_an_epoch_is_one_job_and_shards_learn_together(ready, spark, monkeypatch):
    jobs = []
    keep = nets.Net._epoch
    monkeypatch.setattr(nets.Net, "_epoch", lambda self, *a: jobs.append(a[-1]) or keep(self, *a))
    spark.sparkContext.setJobGroup("net", "net")
    few = net(epochs=6, batch=20, shard_values=300).fit(ready)  # 30 batches in 4 shards
    started = len(spark.sparkContext.statusTracker().getJobIdsForGroup("net"))
    more = net(epochs=6, batch=5, shard_values=300).fit(ready)  # 120 batches
    twice = len(spark.sparkContext.statusTracker().getJobIdsForGroup("net"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == [*range(6)] * 2 and twice == 2 * started < 2 * 30  # not a job or more per batch
    assert few.losses[-1] < 0.7 * few.losses[0] and more.losses[-1] < few.losses[0]
    again = net(epochs=6, batch=20, shard_values=300).fit(ready.repartition(5))
    assert np.allclose(few.curve, again.curve)
    assert few.accuracies(ready, "k").where("epoch = 6").first()["accuracy"] > 0.8
