"""Splits, models, scores and model inspection."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.hashing import uniform
from ...models import ensembles, explain, learners, linear, metrics, nets, prepare, validate
from ...operators import fairness, privacy, sampling
from ...session import written
from ..registry import Tables, md5_sql, query, uniform_sql
from .statistics import SCORED_SQL, scored

# ---- splits -----------------------------------------------------------------------------------------


def _sizes_sql(share: str, name: str) -> str:
    """Rows per stratum by largest remainder."""
    return f"""{name} AS (SELECT s, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, s) <= target - sum(base) OVER ()
        THEN 1 ELSE 0 END AS size FROM (SELECT s, floor(n * {share})::BIGINT AS base, round(n * {share} - floor(n * {share}), 9)
        AS rest, ceil(round(sum(n) OVER () * {share}, 9))::BIGINT AS target FROM c))"""


def _strata_sql(salt: str) -> str:
    return f"""r AS (SELECT o_orderkey, o_orderstatus AS s, row_number() OVER (PARTITION BY o_orderstatus ORDER BY
        {md5_sql(salt, 'o_orderkey')}) AS k FROM orders), c AS (SELECT s, count(*) AS n FROM r GROUP BY s)"""


@query(
    "m1_train_test_split",
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {md5_sql('2026', 'o_orderkey')}) <=
        (SELECT ceil(round(count(*) * 0.2, 9)) FROM orders) AS is_test FROM orders""",
)
def m1(t: Tables):
    return sampling.split_train_test(t.orders, "o_orderkey", 0.2, "2026").select("o_orderkey", "is_test")


@query(
    "m1b_stratified_split",
    f"""WITH {_strata_sql('2026')}, {_sizes_sql('0.2::DOUBLE', 'z')}
        SELECT o_orderkey, s AS o_orderstatus, k <= size AS is_test FROM r JOIN z USING (s)""",
)
def m1b(t: Tables):
    out = sampling.split_train_test(t.orders, "o_orderkey", 0.2, "2026", ["o_orderstatus"])
    return out.select("o_orderkey", "o_orderstatus", "is_test")


@query(
    "m2_exact_count_split",
    f"""WITH {_strata_sql('42')}, t AS (SELECT sum(n) AS n FROM c),
        {_sizes_sql("((SELECT n // 10 FROM t) / (SELECT n FROM t)::DOUBLE)", 'a')},
        {_sizes_sql("((SELECT n // 10 + n // 3 FROM t) / (SELECT n FROM t)::DOUBLE)", 'b')}
        SELECT o_orderkey, CASE WHEN k <= a.size THEN 'train' WHEN k <= b.size THEN 'test' ELSE 'rest' END AS part
        FROM r JOIN a USING (s) JOIN b USING (s)""",
)
def m2(t: Tables):
    n = t.orders.count()
    out = sampling.split_counts(t.orders, "o_orderkey", n // 10, n // 3, "42", ["o_orderstatus"])
    return out.select("o_orderkey", "part")


@query(
    "m3_stratified_folds",
    f"""WITH {_strata_sql('folds')} SELECT o_orderkey, CAST((k - 1) % 5 AS INTEGER) AS fold FROM r""",
)
def m3(t: Tables):
    return sampling.assign_folds(t.orders, "o_orderkey", 5, "folds", ["o_orderstatus"]).select("o_orderkey", "fold")


# ---- data the models learn from ---------------------------------------------------------------------

# character classes whose share of the whole text is a feature
CHARACTERS = {
    "f_a": "aA", "f_e": "eE", "f_i": "iI", "f_o": "oO", "f_u": "uU", "f_grave": "éèêçàÉÈÊÇÀ", "f_umlaut": "äöüßÄÖÜ",
    "f_acute": "ñáíóúÑÁÍÓÚ", "f_th": "hHtT", "f_kw": "kKwW",
}


def text_features(t: Tables) -> DataFrame:
    """Ten character shares per document, over whole texts."""
    size = F.char_length("text")
    shares = [
        F.coalesce(F.try_divide(size - F.char_length(F.translate("text", chars, "")), size), F.lit(0.0)).alias(name)
        for name, chars in CHARACTERS.items()
    ]
    return t.documents.select("doc_id", "lang", "source", *shares)


def language_rows(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Documents with their language as class number: (train, test), written once and read by every pass."""
    df = text_features(t)
    df = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(df).transform(df)
    split = written(sampling.split_train_test(df, "doc_id", 0.2, "2026", ["lang"]), "features")
    return split.where(~F.col("is_test")), split.where("is_test")


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LABELS = list(CHARACTERS)


def revenue_rows(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Line items with their net price in thousands as target: (train, test)."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 1000
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *NUMBERS,
                           "l_returnflag", "l_linestatus", net.alias("net"))
    marked = written(
        df.withColumn("is_test", uniform(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "2026") < 0.2), "lines"
    )
    return marked.where(~F.col("is_test")), marked.where("is_test")


def _classified(model, test: DataFrame) -> DataFrame:
    return metrics.classification_scores(model.transform(test), "label", "prediction")


# ---- cross-validation and search ----------------------------------------------------------------------


@query("m4_cross_validated_score")
def m4(t: Tables):
    train, _ = revenue_rows(t)
    folded = train.withColumn(
        "fold", F.floor(uniform(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "cv") * 5).cast("int")
    )
    folded = folded.select(*NUMBERS, "net", "fold")  # the rows of every fold are cached: no column beside those learned from
    learner = Pipeline(stages=[prepare.columns_to_features(NUMBERS), learners.linear("net")])
    mean, std = validate.cross_validate(learner, written(folded, "folds"), "fold", 5, RegressionEvaluator(labelCol="net", metricName="mae"))
    return train.agg(F.count("*").alias("rows"), F.lit(mean).alias("mae"), F.lit(std).alias("std"))


@query("m5_grid_search")
def m5(t: Tables):
    train, test = language_rows(t)
    folded = written(sampling.assign_folds(train.drop("is_test"), "doc_id", 5, "grid", ["lang"]), "folds")
    forest = learners.forest_classifier("label", trees=100, by_level=True)
    learner = Pipeline(stages=[prepare.columns_to_features(LABELS), forest])
    grid = {forest.featureSubsetStrategy: ["0.3", "0.6", "1.0"], forest.minInstancesPerNode: [1, 2, 5]}
    fitted = validate.search(learner, folded, grid, "fold", 5, metrics.MacroF1())
    table = validate.search_table(fitted, train)
    return table.withColumn("test_f1", _classified(fitted.bestModel, test).select("macro_f1").scalar())


# ---- preparation ---------------------------------------------------------------------------------------


@query(
    "m6_population_scaler",
    f"""WITH p AS (SELECT *, {uniform_sql('2026', 'p_partkey')} < 0.3 AS is_test FROM part),
        f AS (SELECT avg(p_size) AS a, stddev_pop(p_size) AS b, avg(p_retailprice) AS c, stddev_pop(p_retailprice) AS d
              FROM p WHERE NOT is_test)
        SELECT p_partkey, round((p_size - a) / b, 6) AS z_p_size, round((p_retailprice - c) / d, 6) AS z_p_retailprice
        FROM p, f WHERE is_test""",
)
def m6(t: Tables):
    marked = t.part.withColumn("is_test", uniform("p_partkey", "2026") < 0.3)
    _, test = prepare.scale_numbers(marked.where(~F.col("is_test")), marked.where("is_test"), ["p_size", "p_retailprice"])
    return test.select("p_partkey", *[F.round(c, 6).alias(c) for c in ("z_p_size", "z_p_retailprice")])


@query(
    "m7_one_hot_unknown_is_zero",
    """SELECT p_type, count(*) AS n, CASE WHEN p_type <> 'PROMO' THEN 1 ELSE 0 END AS ones FROM part GROUP BY p_type""",
)
def m7(t: Tables):
    coded = prepare.columns_to_features(categories=["p_type"]).fit(t.part.where("p_type <> 'PROMO'")).transform(t.part)
    ones = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return coded.groupBy("p_type").agg(F.count("*").alias("n"), F.max(ones).cast("int").alias("ones"))


def _coded_sql(column: str, start: str) -> str:
    """One-hot entries of a column: most frequent value first, equal counts by value."""
    return f"""SELECT ({start} + row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::INTEGER AS place,
        'o_{column}_' || {column} AS feature, count(*) / (SELECT count(*) FROM part)::DOUBLE AS mean FROM part GROUP BY {column}"""


@query(
    "m8_preprocessing_with_names",
    f"""WITH c AS ({_coded_sql('p_type', '2')} UNION ALL {_coded_sql('p_brand', '2 + (SELECT count(DISTINCT p_type) FROM part)')})
        SELECT place, feature, round(mean, 6) AS mean, round(sqrt(mean * (1 - mean)), 6) AS std FROM c
        UNION ALL SELECT 0, 'z_p_size', 0.0, 1.0 UNION ALL SELECT 1, 'z_p_retailprice', 0.0, 1.0""",
)
def m8(t: Tables):
    ready = prepare.columns_to_features(["p_size", "p_retailprice"], ["p_type", "p_brand"]).fit(t.part).transform(t.part)
    values = ready.select(F.posexplode(vector_to_array("features")).alias("place", "value"))
    names = t.spark.createDataFrame(list(enumerate(prepare.feature_names(ready))), "place int, feature string")
    sums = values.groupBy("place").agg(
        (F.round(F.avg("value"), 6) + 0.0).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("std")
    )
    return names.join(sums, "place")


@query("m9_preprocessing_and_model")
def m9(t: Tables):
    train, test = revenue_rows(t)
    ready = prepare.columns_to_features(NUMBERS, ["l_returnflag", "l_linestatus"])
    return validate.evaluate(validate.Prepared(ready, ensembles.Forest("net", vector="features")), train, test, "net")


# ---- linear models ----------------------------------------------------------------------------------------


@query(
    "m10_least_squares_line",
    """SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem""",
)
def m10(t: Tables):
    model = linear.least_squares(t.lineitem, ["l_quantity"], "l_extendedprice")
    terms = model.table(t.lineitem)
    return terms.agg(
        F.round(F.max(F.when(F.col("term") == "(intercept)", F.col("coefficient"))), 4).alias("intercept"),
        F.round(F.max(F.when(F.col("term") == "l_quantity", F.col("coefficient"))), 4).alias("slope"),
    )


@query("m10b_least_squares_many_features")
def m10b(t: Tables):
    train, test = revenue_rows(t)
    model = linear.least_squares(train, NUMBERS, "net")
    return metrics.regression_scores(model.transform(test), "net", "prediction")


@query("m11_gradient_descent_curve")
def m11(t: Tables):
    train, _ = revenue_rows(t)
    return linear.gradient_descent(train, NUMBERS, "net")[1]


@query("m12_polynomial_degrees")
def m12(t: Tables):
    train, test = revenue_rows(t)
    rows = {
        f"degree {d}": validate.evaluate(Pipeline(stages=[prepare.polynomial(NUMBERS, d), learners.linear("net")]), train, test, "net")
        for d in (1, 2, 3)
    }
    return validate.ladder(rows)


@query("m13_ridge")
def m13(t: Tables):
    train, test = revenue_rows(t)
    learner = Pipeline(stages=[prepare.columns_to_features(NUMBERS, scaled=False), learners.ridge(train, "net", 10.0)])
    return validate.evaluate(learner, train, test, "net")


@query("m14_lasso")
def m14(t: Tables):
    train, test = revenue_rows(t)
    learner = Pipeline(stages=[prepare.columns_to_features(NUMBERS), learners.lasso("net", 0.8)])
    return validate.evaluate(learner, train, test, "net")


@query("m15_logistic_multinomial")
def m15(t: Tables):
    train, test = language_rows(t)
    learner = Pipeline(stages=[prepare.columns_to_features(LABELS), learners.logistic(train, "label")])
    return _classified(learner.fit(train), test)


# ---- trees and nets -----------------------------------------------------------------------------------------


@query("m16_decision_tree")
def m16(t: Tables):
    train, test = revenue_rows(t)
    rows = {
        f"depth {d}": validate.evaluate(ensembles.Forest("net", NUMBERS, trees=1, bootstrap=False, max_depth=d), train, test, "net")
        for d in (5, None)
    }
    return validate.ladder(rows)


@query("m17_random_forest_classifier")
def m17(t: Tables):
    train, test = language_rows(t)
    return _classified(ensembles.Forest("label", LABELS, classes=4, trees=300, per_split="sqrt").fit(train), test)


@query("m17b_random_forest_regressor")
def m17b(t: Tables):
    train, test = revenue_rows(t)
    return validate.evaluate(ensembles.Forest("net", NUMBERS, min_leaf=5), train, test, "net")


# classes by name, one stump each: with one gradient and hessian per class, the best cut is plain SQL
STUMP_SQL = """
    WITH d AS (SELECT {label} AS k, {columns} FROM {table} WHERE {label} IS NOT NULL),
    c AS (SELECT k, (row_number() OVER (ORDER BY k) - 1)::INTEGER AS class, count(*) / (SELECT count(*) FROM d)::DOUBLE AS p FROM d GROUP BY k),
    v AS ({values}),
    f AS (SELECT feature, class, p, v, sum((v.k = c.k)::INTEGER) AS hits, count(*) AS n FROM v, c GROUP BY feature, class, p, v),
    s AS (SELECT *, hits - n * p AS g, n * p * (1 - p) AS h FROM f),
    r AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER a AS gt, sum(h) OVER a AS ht, sum(n) OVER a AS nt,
          lead(v) OVER (PARTITION BY feature, class ORDER BY v) AS above FROM s
          WINDOW w AS (PARTITION BY feature, class ORDER BY v), a AS (PARTITION BY feature, class)),
    x AS (SELECT *, gl * gl / hl + (gt - gl) * (gt - gl) / (ht - hl) - gt * gt / ht AS gain FROM r
          WHERE above IS NOT NULL AND nl >= 20 AND nt - nl >= 20),
    b AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY gain DESC) AS place FROM x)
    SELECT class, feature, round((v + above) / 2, 6) AS cut, round(gain, 6) AS gain, round(ln(p), 6) AS start,
           round(0.1 * gl / hl, 6) AS left_value, round(0.1 * (gt - gl) / (ht - hl), 6) AS right_value
    FROM b WHERE place = 1"""


def _stump_sql(table: str, label: str, columns: list[str]) -> str:
    values = " UNION ALL ".join(f"SELECT k, '{c}' AS feature, {c}::DOUBLE AS v FROM d WHERE {c} IS NOT NULL" for c in columns)
    return STUMP_SQL.format(table=table, label=label, columns=", ".join(columns), values=values)


STUMP_COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("m18c_first_round_of_boosting", _stump_sql("lineitem", "l_returnflag", STUMP_COLUMNS))
def m18c(t: Tables):
    """The first round of softmax boosting with one split per tree: each class's feature, cut, gain and values."""
    df = StringIndexer(inputCol="l_returnflag", outputCol="label", stringOrderType="alphabetAsc").fit(t.lineitem).transform(t.lineitem)
    model = ensembles.Boosting("label", STUMP_COLUMNS, loss="softmax", classes=3, rounds=1, max_leaves=2).fit(df)
    rows = []
    for k, tree in enumerate(model.rounds[0]):
        f = int(tree.feature[0])
        values = [float(model.binner.cuts[f][tree.cut[0]]), float(tree.gain[0]), model.start[k], *map(float, tree.value[1:, 0])]
        rows.append((k, STUMP_COLUMNS[f], *[round(v, 6) for v in values]))
    return t.spark.createDataFrame(
        rows, "class int, feature string, cut double, gain double, start double, left_value double, right_value double"
    )


@query("m18_boosting_many_classes")
def m18(t: Tables):
    train, test = language_rows(t)
    return _classified(ensembles.Boosting("label", LABELS, loss="softmax", classes=4).fit(train), test)


@query("m18b_boosting_regression")
def m18b(t: Tables):
    train, test = revenue_rows(t)
    return validate.evaluate(ensembles.Boosting("net", NUMBERS), train, test, "net")


@query("m19_boosting_on_categories")
def m19(t: Tables):
    train, test = revenue_rows(t)
    learner = ensembles.Boosting("net", NUMBERS, ["l_returnflag", "l_linestatus"])
    return validate.evaluate(learner, train, test, "net")


@query("m20_feed_forward_net_curve")
def m20(t: Tables):
    """Accuracy on the test rows after every epoch."""
    train, test = language_rows(t)
    ready = prepare.columns_to_features(LABELS).fit(train)
    net = nets.Net("label", "features", "doc_id", classes=4, hidden=(32, 16), epochs=100, batch=256, rate=0.01)
    return net.fit(ready.transform(train)).accuracies(ready.transform(test), "label")


# ---- baselines -------------------------------------------------------------------------------------------------


@query(
    "m21_mean_baseline",
    f"""WITH o AS (SELECT *, {uniform_sql('2026', 'o_orderkey')} < 0.2 AS is_test FROM orders)
        SELECT count(*) AS rows, round(avg(abs(o_totalprice - m)), 4) AS mae,
               round(1 - avg(pow(o_totalprice - m, 2)) / var_pop(o_totalprice), 8) + 0.0 AS r2
        FROM o, (SELECT avg(o_totalprice) AS m FROM o WHERE NOT is_test) WHERE is_test""",
)
def m21(t: Tables):
    marked = t.orders.withColumn("is_test", uniform("o_orderkey", "2026") < 0.2)
    out = validate.evaluate(validate.MeanBaseline("o_totalprice"), marked.where(~F.col("is_test")), marked.where("is_test"), "o_totalprice")
    return out.select("rows", F.round("mae", 4).alias("mae"), (F.round("r2", 8) + 0.0).alias("r2"))


@query(
    "m22_majority_baseline",
    f"""WITH o AS (SELECT *, {uniform_sql('2026', 'o_orderkey')} < 0.2 AS is_test FROM orders),
        w AS (SELECT o_orderstatus AS s FROM o WHERE NOT is_test GROUP BY s ORDER BY count(*) DESC, s LIMIT 1)
        SELECT count(*) AS rows, max(s) AS guess, round(avg(CASE WHEN o_orderstatus = s THEN 1.0 ELSE 0.0 END), 8) AS accuracy
        FROM o, w WHERE is_test""",
)
def m22(t: Tables):
    marked = t.orders.withColumn("is_test", uniform("o_orderkey", "2026") < 0.2)
    model = validate.MajorityBaseline("o_orderstatus").fit(marked.where(~F.col("is_test")))
    scored_test = model.transform(marked.where("is_test"))
    accuracy = metrics.classification_scores(scored_test, "o_orderstatus", "prediction").select("rows", "accuracy")
    return accuracy.select("rows", F.lit(model.label).alias("guess"), F.round("accuracy", 8).alias("accuracy"))


@query(
    "m23_group_mean_baseline",
    f"""WITH l AS (SELECT *, {uniform_sql('2026', 'o_orderkey')} < 0.5 AS is_test FROM orders),
        g AS (SELECT o_custkey, avg(o_totalprice) AS m FROM l WHERE NOT is_test GROUP BY o_custkey),
        p AS (SELECT o_totalprice AS y, coalesce(m, (SELECT avg(o_totalprice) FROM l WHERE NOT is_test)) AS q
              FROM l LEFT JOIN g USING (o_custkey) WHERE is_test)
        SELECT count(*) AS rows, round(avg(abs(y - q)), 4) AS mae, round(1 - avg(pow(y - q, 2)) / var_pop(y), 8) AS r2 FROM p""",
)
def m23(t: Tables):
    marked = t.orders.withColumn("is_test", uniform("o_orderkey", "2026") < 0.5)
    learner = validate.GroupMeanBaseline("o_totalprice", ["o_custkey"])
    out = validate.evaluate(learner, marked.where(~F.col("is_test")), marked.where("is_test"), "o_totalprice")
    return out.select("rows", F.round("mae", 4).alias("mae"), F.round("r2", 8).alias("r2"))


# ---- scores ------------------------------------------------------------------------------------------------------


@query(
    "m24_regression_scores",
    """SELECT count(*) AS rows, round(avg(abs(l_extendedprice - l_quantity * 2000)), 4) AS mae,
              round(1 - avg(pow(l_extendedprice - l_quantity * 2000, 2)) / var_pop(l_extendedprice), 8) AS r2 FROM lineitem""",
)
def m24(t: Tables):
    out = metrics.regression_scores(t.lineitem.withColumn("guess", F.col("l_quantity") * 2000), "l_extendedprice", "guess")
    return out.select("rows", F.round("mae", 4).alias("mae"), F.round("r2", 8).alias("r2"))


GUESS_SQL = """p AS (SELECT o_orderstatus AS t, CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 150000 THEN 'O'
               ELSE 'P' END AS g FROM orders),
    r AS (SELECT label, count(*) FILTER (WHERE t = label AND g = label)::DOUBLE AS hit, count(*) FILTER (WHERE g = label) AS guessed,
          count(*) FILTER (WHERE t = label) AS support FROM p, (VALUES ('F'), ('O'), ('P')) AS v(label) GROUP BY label)"""


def guessed(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return t.orders.select("o_orderstatus", F.when(price > 300000, "F").when(price > 150000, "O").otherwise("P").alias("guess"))


@query(
    "m25_accuracy_and_macro_f1",
    f"""WITH {GUESS_SQL} SELECT sum(support)::BIGINT AS rows, round(sum(hit) / sum(support), 8) AS accuracy,
        round(avg(2 * hit / (guessed + support)), 8) AS macro_f1 FROM r""",
)
def m25(t: Tables):
    out = metrics.classification_scores(guessed(t), "o_orderstatus", "guess")
    return out.withColumns({c: F.round(c, 8) for c in ("accuracy", "macro_f1")})


@query(
    "m26_report_per_class",
    f"""WITH {GUESS_SQL} SELECT label, round(hit / guessed, 8) AS precision, round(hit / support, 8) AS recall,
        round(2 * hit / (guessed + support), 8) AS f1, support FROM r""",
)
def m26(t: Tables):
    out = metrics.class_report(guessed(t), "o_orderstatus", "guess")
    return out.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(
    "m27_confusion_matrix",
    f"""WITH {GUESS_SQL}, l AS (SELECT * FROM (VALUES (0, 'P'), (1, 'O'), (2, 'F'), (3, 'X')) AS v(i, x))
        SELECT a.i AS truth_rank, b.i AS guess_rank, a.x AS truth, b.x AS guess, count(p.t) AS n,
               round(coalesce(count(p.t) / nullif((SELECT count(*) FROM p WHERE t = a.x), 0)::DOUBLE, 0), 8) AS share
        FROM l a CROSS JOIN l b LEFT JOIN p ON p.t = a.x AND p.g = b.x GROUP BY a.i, b.i, a.x, b.x""",
)
def m27(t: Tables):
    return metrics.confusion(guessed(t), "o_orderstatus", "guess", ["P", "O", "F", "X"]).withColumn("share", F.round("share", 8))


# ---- inspection ------------------------------------------------------------------------------------------------


@query("m28_permutation_importance")
def m28(t: Tables):
    train, test = language_rows(t)
    model = Pipeline(stages=[prepare.columns_to_features(LABELS), learners.forest_classifier("label")]).fit(train)
    return explain.permutation_importance(model, test, "doc_id", LABELS, explain.wrong("label"), repeats=10)


# a fixed linear rule stands in for a fitted model, so that the shuffles themselves can be checked
RULE = linear.LinearModel(["p_size", "p_partkey"], 890.0, np.array([0.5, 0.1]))


@query(
    "m28b_permutation_importance_of_a_rule",
    f"""WITH c AS (SELECT part.*, r FROM part, (SELECT unnest(range(1, 11)) AS r)),
        a AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY md5(concat_ws('-', CAST(p_partkey AS VARCHAR), 'own'))) AS place FROM c),
        b AS (SELECT r, p_size AS d_size, p_partkey AS d_key, row_number() OVER (PARTITION BY r ORDER BY
              md5(concat_ws('-', CAST(p_partkey AS VARCHAR), 'perm', CAST(r AS VARCHAR)))) AS place FROM c),
        l AS (SELECT f, r, avg(abs(p_retailprice - (890 + 0.5 * CASE WHEN f = 'p_size' THEN d_size ELSE p_size END
              + 0.1 * CASE WHEN f = 'p_partkey' THEN d_key ELSE p_partkey END))) AS loss
              FROM a JOIN b USING (r, place), (VALUES ('p_size'), ('p_partkey')) AS v(f) GROUP BY f, r),
        z AS (SELECT avg(abs(p_retailprice - (890 + 0.5 * p_size + 0.1 * p_partkey))) AS base FROM part)
        SELECT f AS feature, round(avg(loss - base), 6) AS importance, round(stddev_pop(loss - base), 6) AS std FROM l, z GROUP BY f""",
)
def m28b(t: Tables):
    loss = explain.absolute_error("p_retailprice")
    out = explain.permutation_importance(RULE, t.part, "p_partkey", ["p_size", "p_partkey"], loss, 10, "perm")
    return out.withColumns({c: F.round(c, 6) for c in ("importance", "std")})


@query("m29_impurity_importance")
def m29(t: Tables):
    train, _ = revenue_rows(t)
    ready = prepare.columns_to_features(NUMBERS, ["l_returnflag", "l_linestatus"]).fit(train).transform(train)
    entries = explain.impurity_importance(ensembles.Forest("net", vector="features").fit(ready), ready)
    sums = explain.importance_by_source(entries)
    return sums.orderBy(F.desc("importance")).limit(6)


@query("m30_partial_dependence")
def m30(t: Tables):
    train, test = revenue_rows(t)
    model = Pipeline(stages=[prepare.columns_to_features(NUMBERS, scaled=False), learners.tree_regressor("net", 6)]).fit(train)
    return explain.partial_dependence(model, test, "l_extendedprice")


@query(
    "m30b_partial_dependence_of_a_rule",
    """WITH g AS (SELECT DISTINCT unnest([quantile_cont(p_size, 0.05), quantile_cont(p_size, 0.275), quantile_cont(p_size, 0.5),
                  quantile_cont(p_size, 0.725), quantile_cont(p_size, 0.95)]) AS value FROM part)
       SELECT round(value, 6) AS value, count(*) AS rows, round(avg(890 + 0.5 * value + 0.1 * p_partkey), 6) AS mean_prediction
       FROM part, g GROUP BY value""",
)
def m30b(t: Tables):
    out = explain.partial_dependence(RULE, t.part, "p_size", points=5)
    return out.select(F.round("value", 6).alias("value"), "rows", F.round("mean_prediction", 6).alias("mean_prediction"))


def junk_scores(t: Tables) -> DataFrame:
    """Scores worked out from whole texts, written once because the rank steps read them several times."""
    return written(scored(t).withColumn("junk", 1 - F.col("quality")), "scores")


@query(
    "m31_area_under_curve",
    f"""WITH {SCORED_SQL}, r AS (SELECT 1 - quality AS y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
        AS k FROM scored)
        SELECT round((sum(k) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 8)::DOUBLE AS auc FROM r""",
)
def m31(t: Tables):
    df = junk_scores(t)
    return metrics.auc(df, "junk", "score", buckets=8).withColumn("auc", F.round("auc", 8))


@query(
    "m31b_roc_curve",
    f"""WITH {SCORED_SQL}, c AS (SELECT score, count(*) FILTER (WHERE quality = 0) AS p, count(*) FILTER (WHERE quality = 1) AS n
        FROM scored GROUP BY score)
        SELECT score AS threshold, round(sum(n) OVER w / (SELECT sum(n) FROM c)::DOUBLE, 8) AS fpr,
               round(sum(p) OVER w / (SELECT sum(p) FROM c)::DOUBLE, 8) AS tpr FROM c WINDOW w AS (ORDER BY score DESC)""",
)
def m31b(t: Tables):
    df = junk_scores(t)
    return metrics.roc_curve(df, "junk", "score").withColumns({c: F.round(c, 8) for c in ("fpr", "tpr")})


@query("m32_model_ladder")
def m32(t: Tables):
    train, test = language_rows(t)
    ready = prepare.columns_to_features(LABELS)
    rows = {
        "majority": _classified(validate.MajorityBaseline("label").fit(train), test),
        "logistic": _classified(Pipeline(stages=[ready, learners.logistic(train, "label")]).fit(train), test),
        "tree": _classified(Pipeline(stages=[ready, learners.tree_classifier("label", 5)]).fit(train), test),
        "forest": _classified(Pipeline(stages=[ready, learners.forest_classifier("label")]).fit(train), test),
    }
    return validate.ladder(rows)


@query(
    "m33_threshold_at_base_rate",
    f"""WITH {SCORED_SQL}, r AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS k FROM scored),
        p AS (SELECT (1 - avg(1.0 - quality)) * (count(*) - 1) AS place FROM scored)
        SELECT round(max(score) FILTER (WHERE k = floor(place)) + (max(score) FILTER (WHERE k = ceil(place)) -
               max(score) FILTER (WHERE k = floor(place))) * (max(place) - floor(max(place))), 6) AS threshold FROM r, p""",
)
def m33(t: Tables):
    df = junk_scores(t)
    return fairness.base_rate_threshold(df, "score", "junk").select(F.round("threshold", 6).alias("threshold"))


# ---- privacy audits that need models ------------------------------------------------------------------------------

def quality_rows(t: Tables) -> DataFrame:
    """Labelled documents with their character shares, written once and read by every pass."""
    labels = t.labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    return written(text_features(t).join(labels, "doc_id").select("doc_id", "quality", *LABELS), "quality")


def _chance(model, df: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    return model.transform(df).withColumn("p_one", p[1]).withColumn("p_true", F.when(F.col("quality") == 1, p[1]).otherwise(p[0]))


@query("v8_membership_audit")
def v8(t: Tables):
    df = quality_rows(t)
    n = df.count()
    parts = written(sampling.split_counts(df, "doc_id", n // 5, n // 2, "42", ["quality"]), "parts")
    train, test = parts.where("part = 'train'"), parts.where("part = 'test'")
    ready = prepare.columns_to_features(LABELS, scaled=False)
    settings = {
        "overfitted": learners.forest_classifier("quality", depth=30, bootstrap=False),
        "regularised": learners.forest_classifier("quality", trees=100, depth=3, min_leaf=max(1, n // 50)),
    }
    rows = {}
    for name, learner in settings.items():
        both = _chance(Pipeline(stages=[ready, learner]).fit(train), train.unionByName(test))
        both = both.withColumn("member", (F.col("part") == "train").cast("int"))
        hit = (F.col("prediction") == F.col("quality")).cast("double")
        gap = both.agg((F.avg(F.when(F.col("member") == 1, hit)) - F.avg(F.when(F.col("member") == 0, hit))).alias("gap"))
        rows[name] = gap.withColumn("attack_auc", metrics.auc(both, "member", "p_true").scalar())
    return validate.ladder(rows)


@query("v10_synthetic_utility")
def v10(t: Tables):
    df = quality_rows(t)
    parts = sampling.split_train_test(df, "doc_id", 0.3, "2026")
    train, test = parts.where(~F.col("is_test")), parts.where("is_test")
    made = privacy.synthesise_independent(df, "doc_id", [[c] for c in [*LABELS, "quality"]], "syn")
    learner = Pipeline(stages=[
        prepare.columns_to_features(LABELS, scaled=False), learners.forest_classifier("quality", trees=100, depth=5)
    ])
    rows = {}
    for name, source in {"real": train, "synthetic": written(made, "synthetic")}.items():
        rows[name] = metrics.auc(_chance(learner.fit(source), test), "quality", "p_one")
    return validate.ladder(rows)


@query(
    "v8b_attack_curve_of_a_rule",
    f"""WITH {SCORED_SQL}, m AS (SELECT {uniform_sql('member', 'doc_id')} < 0.3 AS member, round(abs(quality - score), 6) AS s FROM scored),
        r AS (SELECT member::INTEGER AS y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS k FROM m)
        SELECT round((sum(k) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)), 8)::DOUBLE AS attack_auc FROM r""",
)
def v8b(t: Tables):
    """The attack's score worked out from written scores: how well a fixed rule's error tells members."""
    df = written(scored(t), "scores").withColumn("member", (uniform("doc_id", "member") < 0.3).cast("int"))
    df = df.withColumn("s", F.round(F.abs(F.col("quality") - F.col("score")), 6))
    return metrics.auc(df, "member", "s").select(F.round("auc", 8).alias("attack_auc"))


@query("x3_duck_typed_learners")
def x3(t: Tables):
    train, test = revenue_rows(t)
    rows = {
        "mean": validate.evaluate(validate.MeanBaseline("net"), train, test, "net"),
        "group mean": validate.evaluate(validate.GroupMeanBaseline("net", ["l_quantity"]), train, test, "net"),
        "least squares": metrics.regression_scores(linear.least_squares(train, NUMBERS, "net").transform(test), "net", "prediction"),
    }
    return validate.ladder(rows)


# ---- closed forms: one feature, so that the check is plain SQL ---------------------------------------------------

KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
LINE_SQL = f"""r AS (SELECT l_extendedprice AS x, l_discount, l_quantity, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS y,
    {uniform_sql('2026', *KEYS)} < 0.2 AS is_test, floor({uniform_sql('cv', *KEYS)} * 5) AS f FROM lineitem),
    t AS (SELECT * FROM r WHERE NOT is_test), e AS (SELECT * FROM r WHERE is_test)"""


def _scores_sql(guess: str, source: str = "e") -> str:
    return f"""SELECT count(*) AS rows, round(avg(abs(y - ({guess}))), 6) AS mae,
        round(1 - avg(pow(y - ({guess}), 2)) / var_pop(y), 6) + 0.0 AS r2 FROM {source}"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in ("mae", "r2")], F.round("mae", 6).alias("mae"), (F.round("r2", 6) + 0.0).alias("r2"))


@query(
    "m4b_cross_validated_line",
    f"""WITH {LINE_SQL}, k AS (SELECT unnest(range(5)) AS k),
        m AS (SELECT k, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t, k WHERE f <> k GROUP BY k),
        s AS (SELECT k, avg(abs(y - (a + b * x))) AS mae FROM t JOIN m ON f = k GROUP BY k)
        SELECT (SELECT count(*) FROM t) AS rows, round(avg(mae), 6) AS mae, round(stddev_pop(mae), 6) AS std FROM s""",
)
def m4b(t: Tables):
    train, _ = revenue_rows(t)
    folded = written(train.withColumn("fold", F.floor(uniform(list(KEYS), "cv") * 5).cast("int")), "folds")
    learner = Pipeline(stages=[prepare.columns_to_features(["l_extendedprice"]), learners.linear("net")])
    mean, std = validate.cross_validate(learner, folded, "fold", 5, RegressionEvaluator(labelCol="net", metricName="mae"))
    return train.agg(F.count("*").alias("rows"), F.round(F.lit(mean), 6).alias("mae"), F.round(F.lit(std), 6).alias("std"))


@query(
    "m11b_gradient_descent_line",
    f"""WITH {LINE_SQL}, c AS (SELECT covar_pop(y, x) / stddev_pop(x) AS c, var_pop(y) AS yy, avg(y) AS m FROM t)
        SELECT i::INTEGER AS step, round(yy - c * c + (c * c + m * m) * pow(0.4, 2 * i), 6) AS loss
        FROM c, (SELECT unnest(range(100)) AS i)""",
)
def m11b(t: Tables):
    train, _ = revenue_rows(t)
    return linear.gradient_descent(train, ["l_extendedprice"], "net")[1].withColumn("loss", F.round("loss", 6))


@query(
    "m12b_polynomial_of_degree_one",
    f"WITH {LINE_SQL}, m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t) " + _scores_sql("a + b * x", "e, m"),
)
def m12b(t: Tables):
    train, test = revenue_rows(t)
    learner = Pipeline(stages=[prepare.polynomial(["l_extendedprice"], 1), learners.linear("net")])
    return _rounded(validate.evaluate(learner, train, test, "net"))


@query(
    "m13b_ridge_line",
    f"""WITH {LINE_SQL}, m AS (SELECT covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + 10) AS b, avg(x) AS mx, avg(y) AS my FROM t) """
    + _scores_sql("my + b * (x - mx)", "e, m"),
)
def m13b(t: Tables):
    train, test = revenue_rows(t)
    learner = Pipeline(stages=[prepare.columns_to_features(["l_extendedprice"], scaled=False), learners.ridge(train, "net", 10.0)])
    return _rounded(validate.evaluate(learner, train, test, "net"))


@query(
    "m14b_lasso_line",
    f"""WITH {LINE_SQL}, c AS (SELECT covar_pop(y, x) / stddev_pop(x) AS c, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my FROM t),
        m AS (SELECT sign(c) * greatest(abs(c) - 0.8, 0) AS b, mx, sx, my FROM c) """
    + _scores_sql("my + b * (x - mx) / sx", "e, m").replace(", 6)", ", 4)"),
)
def m14b(t: Tables):
    train, test = revenue_rows(t)
    learner = Pipeline(stages=[prepare.columns_to_features(["l_extendedprice"]), learners.lasso("net", 0.8)])
    out = validate.evaluate(learner, train, test, "net")
    return out.select("rows", F.round("mae", 4).alias("mae"), (F.round("r2", 4) + 0.0).alias("r2"))


@query(
    "m16b_stump",
    f"""WITH {LINE_SQL}, d AS (SELECT DISTINCT l_discount AS v FROM t),
        s AS (SELECT v, sum(CASE WHEN l_discount <= v THEN y END) AS ls, count(CASE WHEN l_discount <= v THEN 1 END) AS ln,
              sum(CASE WHEN l_discount > v THEN y END) AS rs, count(CASE WHEN l_discount > v THEN 1 END) AS rn FROM t, d GROUP BY v),
        m AS (SELECT v, ls / ln AS l, rs / rn AS r FROM s WHERE rn > 0 ORDER BY ls * ls / ln + rs * rs / rn DESC LIMIT 1) """
    + _scores_sql("CASE WHEN l_discount <= v THEN l ELSE r END", "e, m"),
)
def m16b(t: Tables):
    """A tree of depth 1 on a column of few values, where all split candidates are exact."""
    train, test = revenue_rows(t)
    learner = Pipeline(stages=[prepare.columns_to_features(["l_discount"], scaled=False), learners.tree_regressor("net", 1)])
    return _rounded(validate.evaluate(learner, train, test, "net"))


@query(
    "x2_fit_and_transform",
    f"""WITH {LINE_SQL}, m AS (SELECT avg(x) AS a, stddev_pop(x) AS s, avg(l_quantity) AS b, stddev_pop(l_quantity) AS q FROM t)
        SELECT count(*) AS rows, round(avg((x - a) / s), 6) + 0.0 AS z_price, round(stddev_pop((x - a) / s), 6) AS std_price,
               round(avg((l_quantity - b) / q), 6) + 0.0 AS z_quantity FROM e, m""",
)
def x2(t: Tables):
    """A fitted stage carries what it learned on one table to another."""
    train, test = revenue_rows(t)
    scaler = prepare.PopulationScaler(inputCols=["l_extendedprice", "l_quantity"], outputCols=["z_p", "z_q"])
    scaled = scaler.fit(train).transform(test)
    return scaled.agg(
        F.count("*").alias("rows"),
        (F.round(F.avg("z_p"), 6) + 0.0).alias("z_price"),
        F.round(F.stddev_pop("z_p"), 6).alias("std_price"),
        (F.round(F.avg("z_q"), 6) + 0.0).alias("z_quantity"),
    )


@query(
    "x3b_duck_typed_baselines",
    f"""WITH {LINE_SQL}, g AS (SELECT l_quantity, avg(y) AS m FROM t GROUP BY l_quantity),
        p AS (SELECT e.*, coalesce(m, (SELECT avg(y) FROM t)) AS q, (SELECT avg(y) FROM t) AS a FROM e LEFT JOIN g USING (l_quantity)),
        l AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS i FROM t)
        SELECT 0 AS rank, 'mean' AS model, * FROM ({_scores_sql("a", "p")}) UNION ALL
        SELECT 1, 'group mean', * FROM ({_scores_sql("q", "p")}) UNION ALL
        SELECT 2, 'least squares', * FROM ({_scores_sql("i + b * x", "p, l")})""",
)
def x3b(t: Tables):
    train, test = revenue_rows(t)
    line = linear.least_squares(train, ["l_extendedprice"], "net").transform(test)
    rows = {
        "mean": validate.evaluate(validate.MeanBaseline("net"), train, test, "net"),
        "group mean": validate.evaluate(validate.GroupMeanBaseline("net", ["l_quantity"]), train, test, "net"),
        "least squares": metrics.regression_scores(line, "net", "prediction"),
    }
    return _rounded(validate.ladder(rows))
