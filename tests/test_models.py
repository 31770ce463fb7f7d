import inspect

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.models import explain, learners, linear, metrics, prepare, validate
from tabloom.plans.catalog import modelling


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(11)
    n = 300
    x = rng.normal(size=(n, 3)) * [1, 5, 0.2] + [0, 10, 3]
    y = 2 + x @ [1.5, -0.4, 3.0] + rng.normal(0, 0.5, n)
    return pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y,
                         "k": (y > np.median(y)).astype(int), "g": rng.choice(["u", "v", "w"], n)})


@pytest.fixture(scope="module")
def df(spark, table):
    return spark.createDataFrame(table).cache()


X = ["a", "b", "c"]


def test_scaler_uses_population_deviation_of_train_only(spark):
    train = spark.createDataFrame([(10.0, 1.0), (20.0, 1.0), (30.0, 1.0)], "v double, c double")
    test = spark.createDataFrame([(40.0, 2.0), (50.0, 1.0)], "v double, c double")
    _, out = prepare.scale_numbers(train, test, ["v", "c"])
    std = np.std([10, 20, 30])
    assert sorted(r["z_v"] for r in out.collect()) == pytest.approx([20 / std, 30 / std])
    assert sorted(r["z_c"] for r in out.collect()) == [0.0, 1.0]


def test_least_squares_exact_line(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, y double")
    model = linear.least_squares(df, ["x"], "y")
    assert (model.intercept, model.slopes[0]) == pytest.approx((0.0, 2.0), abs=1e-9)


def test_least_squares_equals_numpy_and_descent(df, table):
    design = np.c_[np.ones(len(table)), table[X]]
    beta = np.linalg.lstsq(design, table["y"], rcond=None)[0]
    model = linear.least_squares(df, X, "y")
    assert [model.intercept, *model.slopes] == pytest.approx(list(beta))
    gd, curve = linear.gradient_descent(df, X, "y", steps=200)
    assert [gd.intercept, *gd.slopes] == pytest.approx(list(beta), abs=1e-3)
    losses = [r["loss"] for r in curve.orderBy("step").collect()]
    assert losses[0] == pytest.approx(float((table["y"] ** 2).mean()))
    assert all(a >= b - 1e-12 for a, b in zip(losses, losses[1:], strict=False))


def test_ridge_equals_closed_form(df, table):
    ready = prepare.columns_to_features(X, scaled=False).fit(df).transform(df)
    model = learners.ridge(ready, "y", 10.0).fit(ready)
    xc, yc = table[X] - table[X].mean(), table["y"] - table["y"].mean()
    want = np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(list(want), rel=1e-6)


def test_lasso_equals_coordinate_descent(df, table):
    ready = prepare.columns_to_features(X).fit(df).transform(df)
    model = learners.lasso("y", 0.3).fit(ready)
    z = ((table[X] - table[X].mean()) / table[X].std(ddof=0)).to_numpy()
    y, w = (table["y"] - table["y"].mean()).to_numpy(), np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rho = z[:, j] @ (y - z @ w + z[:, j] * w[j]) / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - 0.3, 0)
    assert list(model.coefficients) == pytest.approx(list(w), abs=1e-3)


def test_logistic_equals_newton(df, table):
    ready = prepare.columns_to_features(X).fit(df).transform(df)
    model = learners.logistic(ready, "k").fit(ready)
    z = np.c_[np.ones(len(table)), (table[X] - table[X].mean()) / table[X].std(ddof=0)]
    w, penalty = np.zeros(4), np.diag([0.0, 1, 1, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (p - table["k"]) + penalty @ w)
    assert [model.intercept, *model.coefficients] == pytest.approx(list(w), abs=1e-2)


def test_unknown_category_is_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    test = spark.createDataFrame([("a",), ("b",), ("new",)], "g string")
    model = prepare.columns_to_features(categories=["g"]).fit(train)
    got = {r["g"]: list(r["v"]) for r in model.transform(test).select("g", vector_to_array("features").alias("v")).collect()}
    assert got == {"a": [1.0, 0.0], "b": [0.0, 1.0], "new": [0.0, 0.0]}
    assert prepare.feature_names(model.transform(test)) == ["o_g_a", "o_g_b"]


def test_names_and_importances(df):
    ready = prepare.columns_to_features(X, ["g"]).fit(df).transform(df)
    assert prepare.feature_names(ready)[:3] == ["z_a", "z_b", "z_c"]
    model = learners.forest_regressor("y", trees=5, depth=4).fit(ready)
    by = {r["source"]: r for r in explain.importance_by_source(explain.impurity_importance(model, ready)).collect()}
    assert set(by) == {"a", "b", "c", "g"} and by["g"]["entries"] == 3
    assert sum(r["importance"] for r in by.values()) == pytest.approx(1.0)


def test_cross_validation_uses_the_given_folds(df):
    from pyspark.ml.evaluation import RegressionEvaluator

    from tabloom.operators.sampling import assign_folds

    folded = assign_folds(df, "id", 5, "f")
    learner = Pipeline(stages=[prepare.columns_to_features(X), learners.linear("y")])
    mean, std = validate.cross_validate(learner, folded, "fold", 5, RegressionEvaluator(labelCol="y", metricName="mae"))
    assert 0.3 < mean < 0.5 and std < 0.1


def test_grid_search_table(df):
    from tabloom.operators.sampling import assign_folds

    folded = assign_folds(df, "id", 2, "f")
    tree = learners.tree_classifier("k")
    learner = Pipeline(stages=[prepare.columns_to_features(X, scaled=False), tree])
    fitted = validate.search(learner, folded, {tree.maxDepth: [1, 4]}, "fold", 2, metrics.MacroF1("k"))
    rows = validate.search_table(fitted, df).collect()
    assert sorted(r["setting"] for r in rows) == ["maxDepth=1", "maxDepth=4"]
    assert all(0.5 < r["mean"] <= 1 for r in rows)


def test_class_report_counts_labels_seen_on_either_side(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("a", "d")], "t string, g string")
    rep = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in metrics.class_report(df, "t", "g").collect()}
    assert rep["a"] == pytest.approx((0.5, 1 / 3, 0.4, 3))
    assert rep["c"] == (0.0, 0.0, 0.0, 1) and rep["d"] == (0.0, 0.0, 0.0, 0)
    row = metrics.classification_scores(df, "t", "g").first()
    assert row["accuracy"] == pytest.approx(0.4)
    assert row["macro_f1"] == pytest.approx((0.4 + 2 / 3 + 0 + 0) / 4)


def test_confusion_keeps_empty_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "t string, g string")
    got = {(r["truth"], r["guess"]): (r["n"], r["share"]) for r in metrics.confusion(df, "t", "g", ["a", "b"]).collect()}
    assert got == {("a", "a"): (1, 0.5), ("a", "b"): (1, 0.5), ("b", "a"): (0, 0.0), ("b", "b"): (0, 0.0)}


def test_baselines(df, table):
    model = validate.GroupMeanBaseline("y", ["g"]).fit(df.where("g <> 'w'"))
    got = {r["g"]: r["prediction"] for r in model.transform(df).select("g", "prediction").distinct().collect()}
    known = table[table["g"] != "w"]
    assert got["u"] == pytest.approx(table[table["g"] == "u"]["y"].mean())
    assert got["w"] == pytest.approx(known["y"].mean())
    assert validate.MajorityBaseline("g").fit(df).label == table["g"].value_counts().sort_index().idxmax()


def test_permutation_importance_ranks_the_useless_feature_last(df):
    model = linear.least_squares(df, X, "y")
    imp = {r["feature"]: r["importance"] for r in explain.permutation_importance(
        model, df.withColumn("n", F.rand(1)), "id", X, explain.absolute_error("y"), 3).collect()}
    assert imp["b"] > imp["c"] > 0 and imp["a"] > 0


def test_perceptron_curve_continues_from_its_weights(df):
    ready = prepare.columns_to_features(X).fit(df).transform(df)
    curve = learners.perceptron_curve(ready, "k", [3, 8, 2], (5, 30))
    scores = [metrics.classification_scores(m.transform(ready), "k", "prediction").first()["accuracy"] for _, m in curve]
    assert scores[-1] > 0.9


def test_many_class_boosting(df):
    three = df.withColumn("k3", F.when(F.col("y") < 2, 0).when(F.col("y") < 8, 1).otherwise(2))
    learner = Pipeline(stages=[prepare.columns_to_features(X, scaled=False), learners.boosting_classifier("k3", 3, rounds=2, depth=3, min_leaf=2)])
    out = learner.fit(three).transform(three)
    assert metrics.classification_scores(out, "k3", "prediction").first()["accuracy"] > 0.8


class Built(Exception):
    """Raised in place of a fit."""


@pytest.mark.parametrize(
    "name, want",
    [("m9", {"trees": 100, "max_depth": None}), ("m17", {"trees": 300, "max_depth": None, "classes": 4}),
     ("m17b", {"trees": 100, "max_depth": None}), ("m29", {"trees": 100, "max_depth": None}), ("m16", {"trees": 1, "bootstrap": False}),
     ("m18", {"rounds": 100, "max_leaves": 31, "min_leaf": 20, "loss": "softmax", "classes": 4}),
     ("m18b", {"rounds": 100, "max_leaves": 31, "min_leaf": 20}), ("m19", {"rounds": 100, "max_leaves": 31, "max_bins": 255}),
     ("m20", {"epochs": 100, "batch": 256, "hidden": (32, 16), "rate": 0.01}),
     ("m28", {"numTrees": 300, "maxDepth": 15}), ("m32", {"numTrees": 300, "maxDepth": 15}), ("m5", {"numTrees": 100, "maxDepth": 15})],
)
def test_queries_fit_whole_models(spark, monkeypatch, name, want):
    seen = {}

    def noted(build):
        def run(*args, **options):
            learner = build(*args, **options)
            one = learner.getClassifier() if hasattr(learner, "getClassifier") else learner
            seen.update({p.name: v for p, v in one.extractParamMap().items()})
            if name == "m5":
                return learner
            raise Built

        return run

    def searched(learner, df, grid, fold, folds, evaluator):
        seen.update(folds=folds, **{p.name: values for p, values in grid.items()})
        raise Built

    rows = spark.createDataFrame([(i, str(i % 4), float(i)) for i in range(8)], "doc_id long, lang string, label double")
    rows = rows.selectExpr("*", "label AS net", "false AS is_test", *[f"label AS {c}" for c in [*modelling.LABELS, *modelling.NUMBERS]],
                           "lang AS l_returnflag", "lang AS l_linestatus")
    for source in ("language_rows", "revenue_rows"):
        monkeypatch.setattr(modelling, source, lambda t: (rows, rows))
    for build in ("forest_classifier", "forest_regressor", "boosting_classifier", "boosting_regressor"):
        monkeypatch.setattr(modelling.learners, build, noted(getattr(modelling.learners, build)))
    monkeypatch.setattr(modelling.validate, "search", searched)

    def settings_of(build):
        def run(*args, **options):
            bound = inspect.signature(build).bind(*args, **options)
            bound.apply_defaults()
            seen.update(bound.arguments)
            raise Built

        return run

    for module, build in ((modelling.ensembles, "Forest"), (modelling.ensembles, "Boosting"), (modelling.nets, "Net")):
        monkeypatch.setattr(module, build, settings_of(getattr(module, build)))
    if name == "m5":
        want = want | {"folds": 5, "featureSubsetStrategy": ["0.3", "0.6", "1.0"], "minInstancesPerNode": [1, 2, 5]}
    with pytest.raises(Built):
        getattr(modelling, name)(None)
    assert {k: seen[k] for k in want} == want


def test_cross_validation_caches_only_what_it_learns_from(spark, monkeypatch):
    from tabloom.plans.catalog import modelling
    from tabloom.plans.registry import Tables

    seen = []
    monkeypatch.setattr(modelling.validate, "cross_validate", lambda learner, df, *a: seen.append(df.columns) or (0.0, 0.0))
    modelling.m4(Tables(spark, "/root/testdata/sf0.001"))
    assert seen == [[*modelling.NUMBERS, "net", "fold"]]
