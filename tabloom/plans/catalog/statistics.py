"""Distribution tables, estimates, tests, fairness and drift."""

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.hashing import uniform
from ...operators import distributions as dist
from ...operators import aggregators, fairness, inference, resampling
from ...session import written
from ..registry import Tables, md5_sql, query, uniform_sql

# ---- distributions -----------------------------------------------------------------------


@query(
    "d1_histogram",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 24.0 AS w FROM events),
       b AS (SELECT CAST(least(floor((value - lo) / w), 23) AS INTEGER) AS bin, count(*) AS n FROM events, e GROUP BY 1)
       SELECT r.bin, round(lo + r.bin * w, 6) AS low, round(lo + (r.bin + 1) * w, 6) AS high, coalesce(n, 0) AS n,
              round(coalesce(n, 0) / ((SELECT count(*) FROM events) * w), 8) AS density
       FROM (SELECT CAST(unnest(range(24)) AS INTEGER) AS bin) r CROSS JOIN e LEFT JOIN b ON b.bin = r.bin""",
)
def d1(t: Tables):
    out = dist.histogram(t.events, "value", 24)
    return out.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n",
                      F.round("density", 8).alias("density"))


@query(
    "d2_density_curve",
    """WITH f AS (SELECT count(*)::DOUBLE AS n, stddev_samp(o_totalprice) * pow(count(*)::DOUBLE, -0.2) AS h,
              min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
       g AS (SELECT i AS point, lo + i * ((hi - lo) / 199.0) AS x FROM f, (SELECT unnest(range(200)) AS i))
       SELECT CAST(point AS INTEGER) AS point, round(x, 4) AS x,
              round(sum(exp(-0.5 * pow((x - o_totalprice) / h, 2))) / (n * h * sqrt(2 * pi())) * 1000000, 6) AS density_e6
       FROM g, orders, f GROUP BY point, x, n, h""",
)
def d2(t: Tables):
    out = dist.density_curve(t.orders, "o_totalprice", 200)
    return out.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density_e6"))


@query(
    "d2b_binned_density_curve",
    """WITH f AS (SELECT count(*)::DOUBLE AS n, stddev_samp(l_extendedprice) * pow(count(*)::DOUBLE, -0.2) AS h,
              min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
       b AS (SELECT (floor((l_extendedprice - lo) / (h / 10.0)) + 0.5) * (h / 10.0) + lo AS c, count(*) AS m
             FROM lineitem, f GROUP BY c),
       g AS (SELECT i AS point, lo + i * ((hi - lo) / 199.0) AS x FROM f, (SELECT unnest(range(200)) AS i))
       SELECT CAST(point AS INTEGER) AS point, round(x, 4) AS x,
              round(sum(m * exp(-0.5 * pow((x - c) / h, 2))) / (n * h * sqrt(2 * pi())) * 1000000, 6) AS density_e6
       FROM g, b, f GROUP BY point, x, n, h""",
)
def d2b(t: Tables):
    out = dist.density_curve(t.lineitem, "l_extendedprice", 200, per_bandwidth=10)
    return out.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density_e6"))


@query(
    "d2c_density_curve_of_lines",
    """WITH f AS (SELECT count(*)::DOUBLE AS n, stddev_samp(l_extendedprice) * pow(count(*)::DOUBLE, -0.2) AS h,
              min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
       g AS (SELECT i AS point, lo + i * ((hi - lo) / 199.0) AS x FROM f, (SELECT unnest(range(200)) AS i))
       SELECT CAST(point AS INTEGER) AS point, round(x, 4) AS x,
              round(sum(exp(-0.5 * pow((x - l_extendedprice) / h, 2))) / (n * h * sqrt(2 * pi())) * 1000000, 6) AS density_e6
       FROM g, lineitem, f GROUP BY point, x, n, h""",
)
def d2c(t: Tables):
    out = dist.density_curve(t.lineitem, "l_extendedprice", 200)
    return out.select("point", F.round("x", 4).alias("x"), F.round(F.col("density") * 1e6, 6).alias("density_e6"))


@query(
    "d3_ecdf",
    """SELECT DISTINCT event_type, value, round(cume_dist() OVER (PARTITION BY event_type ORDER BY value), 8) AS share
       FROM events""",
)
def d3(t: Tables):
    out = dist.ecdf(t.events, "value", by=["event_type"])
    return out.select("event_type", "value", F.round("share", 8).alias("share"))


@query(
    "d4_box_summary",
    """WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
       f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
       SELECT event_type, max(n) AS n, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
              round(max(lo), 6) AS low_fence, round(max(hi), 6) AS high_fence,
              min(value) FILTER (WHERE value BETWEEN lo AND hi) AS low_whisker,
              max(value) FILTER (WHERE value BETWEEN lo AND hi) AS high_whisker,
              count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS outliers
       FROM events JOIN f USING (event_type) GROUP BY event_type""",
)
def d4(t: Tables):
    out = dist.box_summary(t.events, "value", ["event_type"])
    return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "low_fence", "high_fence")})


@query(
    "d5_hexagonal_bins",
    """WITH e AS (SELECT min(o_orderkey) AS x0, max(o_orderkey) AS x1, min(o_totalprice) AS y0, max(o_totalprice) AS y1 FROM orders),
       s AS (SELECT (o_orderkey - x0) / (x1 - x0)::DOUBLE * 28.0 AS ix, (o_totalprice - y0) / (y1 - y0) * 16.0 AS iy FROM orders, e),
       c AS (SELECT floor(ix + 0.5) AS i1, floor(iy + 0.5) AS j1, floor(ix) AS i2, floor(iy) AS j2, ix, iy FROM s),
       d AS (SELECT *, pow(ix - i1, 2) + 3 * pow(iy - j1, 2) < pow(ix - i2 - 0.5, 2) + 3 * pow(iy - j2 - 0.5, 2) AS a FROM c)
       SELECT CASE WHEN a THEN 1 ELSE 2 END AS lattice, CAST(CASE WHEN a THEN i1 ELSE i2 END AS BIGINT) AS i,
              CAST(CASE WHEN a THEN j1 ELSE j2 END AS BIGINT) AS j, count(*) AS n FROM d GROUP BY ALL""",
)
def d5(t: Tables):
    return dist.hexbin(t.orders, "o_orderkey", "o_totalprice", 28)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "d6_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in MEASURES for b in MEASURES
    ),
)
def d6(t: Tables):
    return dist.correlation_matrix(t.lineitem, MEASURES).withColumn("r", F.round("r", 6))


@query(
    "d7_correlation_with_target",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature, count(*) AS n, round(corr({a}, l_extendedprice), 6) AS r FROM lineitem"
        for a in ("l_quantity", "l_discount", "l_tax")
    ),
)
def d7(t: Tables):
    out = dist.correlation_with(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return out.withColumn("r", F.round("r", 6))


@query(
    "d8_line_per_group",
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS x_mean, round(avg(l_extendedprice), 4) AS y_mean,
              round(stddev_samp(l_quantity), 6) AS x_std, round(stddev_samp(l_extendedprice), 4) AS y_std,
              round(corr(l_quantity, l_extendedprice), 6) AS r, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY l_returnflag""",
)
def d8(t: Tables):
    out = dist.line_by_group(t.lineitem, ["l_returnflag"], "l_quantity", "l_extendedprice")
    digits = {"x_mean": 6, "y_mean": 4, "x_std": 6, "y_std": 4, "r": 6, "slope": 4, "intercept": 3}
    return out.withColumns({c: F.round(c, k) for c, k in digits.items()})


@query(
    "d9_outlier_flags",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, avg(value) AS m,
                  stddev_samp(value) AS s FROM events)
       SELECT event_type, sum(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END)::BIGINT
              AS fenced, sum(CASE WHEN abs(value - m) > 3 * s THEN 1 ELSE 0 END)::BIGINT AS far FROM events, q GROUP BY event_type""",
)
def d9(t: Tables):
    rows = dist.outlier_flags(t.events.select("event_type", "value"), "value")
    return rows.groupBy("event_type").agg(
        F.count_if("outside_fences").alias("fenced"), F.count_if("beyond_sigmas").alias("far")
    )


# ---- estimates and tests ---------------------------------------------------------------------


@query(
    "t1_skewness_of_batch_means",
    """WITH m AS (SELECT avg(value) AS m FROM events GROUP BY event_id // 30)
       SELECT count(*) AS batches, round(skewness(m) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 6) AS skewness FROM m""",
)
def t1(t: Tables):
    out = inference.skewness_of_batch_means(t.events, "value", F.floor(F.col("event_id") / 30))
    return out.withColumn("skewness", F.round("skewness", 6))


@query(
    "t2_interval_of_the_mean",
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean,
              round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(*)), 6) AS low,
              round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(*)), 6) AS high FROM events GROUP BY event_type""",
)
def t2(t: Tables):
    out = inference.mean_interval(t.events, "value", ["event_type"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "low", "high")})


REPLICATES = 10_000


def _poisson_sql(u: str) -> str:
    import math

    total, terms = 0.0, []
    for k in range(12):
        total += math.exp(-1.0) / math.factorial(k)
        terms.append(f"CASE WHEN {u} >= {total!r}::DOUBLE THEN 1 ELSE 0 END")
    return " + ".join(terms)


@query(
    "t3_bootstrap_interval",
    f"""WITH w AS (SELECT s_acctbal, b * 4 + p AS r, CAST('0x' || substr(md5(concat_ws('-', CAST(s_suppkey AS VARCHAR), 'boot',
              CAST(b AS VARCHAR))), CAST(1 + 8 * p AS INTEGER), 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u
              FROM supplier, (SELECT unnest(range({REPLICATES // 4})) AS b), (SELECT unnest(range(4)) AS p)),
        x AS (SELECT r, s_acctbal, {_poisson_sql('u')} AS k FROM w),
        e AS (SELECT r, sum(k * s_acctbal) / sum(k) AS m FROM x WHERE k > 0 GROUP BY r)
        SELECT count(*) AS replicates, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM e""",
)
def t3(t: Tables):
    out = resampling.bootstrap_interval(t.supplier, "s_suppkey", "s_acctbal", REPLICATES, "boot")
    return out.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query(
    "t3b_exact_size_bootstrap",
    f"""WITH i AS (SELECT row_number() OVER (ORDER BY {md5_sql('ex-index', 's_suppkey')}) - 1 AS i, s_acctbal AS x FROM supplier),
        d AS (SELECT r, CAST(floor({uniform_sql('ex', 'i.i', 'r')} * (SELECT count(*) FROM i)) AS BIGINT) AS j
              FROM i, (SELECT unnest(range(1000)) AS r)),
        e AS (SELECT r, avg(x) AS m FROM d JOIN i ON i.i = j GROUP BY r)
        SELECT count(*) AS replicates, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM e""",
)
def t3b(t: Tables):
    out = resampling.bootstrap_interval(t.supplier, "s_suppkey", "s_acctbal", 1000, "ex", exact_size=True)
    return out.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query(
    "t3c_bootstrap_interval_of_events",
    f"""WITH w AS (SELECT value, b * 4 + p AS r, CAST('0x' || substr(md5(concat_ws('-', CAST(event_id AS VARCHAR), 'boot',
              CAST(b AS VARCHAR))), CAST(1 + 8 * p AS INTEGER), 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u
              FROM events, (SELECT unnest(range({REPLICATES // 4})) AS b), (SELECT unnest(range(4)) AS p)),
        x AS (SELECT r, value, {_poisson_sql('u')} AS k FROM w),
        e AS (SELECT r, sum(k * value) / sum(k) AS m FROM x WHERE k > 0 GROUP BY r)
        SELECT count(*) AS replicates, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM e""",
)
def t3c(t: Tables):
    out = resampling.bootstrap_interval(t.events, "event_id", "value", REPLICATES, "boot")
    return out.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query(
    "t3d_exact_size_bootstrap_10000",
    f"""WITH i AS (SELECT row_number() OVER (ORDER BY {md5_sql('ex-index', 's_suppkey')}) - 1 AS i, s_acctbal AS x FROM supplier),
        d AS (SELECT r, CAST(floor({uniform_sql('ex', 'i.i', 'r')} * (SELECT count(*) FROM i)) AS BIGINT) AS j
              FROM i, (SELECT unnest(range({REPLICATES})) AS r)),
        e AS (SELECT r, avg(x) AS m FROM d JOIN i ON i.i = j GROUP BY r)
        SELECT count(*) AS replicates, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM e""",
)
def t3d(t: Tables):
    out = resampling.bootstrap_interval(t.supplier, "s_suppkey", "s_acctbal", REPLICATES, "ex", exact_size=True)
    return out.withColumns({c: F.round(c, 6) for c in ("low", "high")})


WELCH_SQL = """WITH f AS (SELECT count(*) FILTER (WHERE event_type = 'click')::DOUBLE AS n1,
    avg(value) FILTER (WHERE event_type = 'click') AS m1, var_samp(value) FILTER (WHERE event_type = 'click') AS v1,
    count(*) FILTER (WHERE event_type = 'view')::DOUBLE AS n2, avg(value) FILTER (WHERE event_type = 'view') AS m2,
    var_samp(value) FILTER (WHERE event_type = 'view') AS v2 FROM events)"""


@query(
    "t4_welch_test",
    WELCH_SQL
    + """ SELECT n1::BIGINT AS n1, n2::BIGINT AS n2, round(m1, 6) AS mean1, round(m2, 6) AS mean2,
              round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t,
              round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS df FROM f""",
)
def t4(t: Tables):
    out = inference.welch(t.events, "value", F.col("event_type") == "click", F.col("event_type") == "view")
    digits = {"mean1": 6, "mean2": 6, "t": 6, "df": 4}
    return out.select("n1", "n2", *[F.round(c, k).alias(c) for c, k in digits.items()])


def _t_tail_sql(t: str, df: str) -> str:
    """Two-sided p of Student's t by Simpson's rule over 400 steps."""

    def integral(low: str) -> str:
        h = f"((least(pi() / 2, 40 / sqrt({df})) - {low}) / 400.0)"
        weight = "CASE WHEN i IN (0, 400) THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END"
        return f"(SELECT sum(CAST({weight} AS DOUBLE) * pow(cos({low} + i * {h}), {df} - 1)) * {h} / 3 FROM (SELECT unnest(range(401)) AS i))"

    return f"{integral(f'atan(abs({t}) / sqrt({df}))')} / {integral('0.0')}"


@query(
    "t4b_welch_p_value",
    WELCH_SQL
    + f""", w AS (SELECT (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t, pow(v1 / n1 + v2 / n2, 2) /
          (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM f)
          SELECT round({_t_tail_sql('t', 'df')}, 8) AS p FROM w""",
)
def t4b(t: Tables):
    out = inference.welch(t.events, "value", F.col("event_type") == "click", F.col("event_type") == "view")
    return out.select(F.round("p", 8).alias("p"))


@query(
    "t5_cohen_d",
    WELCH_SQL + """ SELECT round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 6) AS cohen_d FROM f""",
)
def t5(t: Tables):
    out = inference.welch(t.events, "value", F.col("event_type") == "click", F.col("event_type") == "view")
    return out.select(F.round("cohen_d", 6).alias("cohen_d"))


PERMUTED_SQL = f"""WITH a AS (SELECT s_suppkey, s_acctbal AS x, (s_nationkey < 12)::INTEGER AS f FROM supplier),
        o AS (SELECT sum(f) AS n1, {{0}} - {{1}} AS seen FROM a),
        p AS (SELECT r, x, (row_number() OVER (PARTITION BY r ORDER BY md5(concat_ws('-', CAST(s_suppkey AS VARCHAR), '{{4}}',
              CAST(r AS VARCHAR)))) <= (SELECT n1 FROM o))::INTEGER AS f FROM a, (SELECT unnest(range(1, {REPLICATES + 1})) AS r)),
        g AS (SELECT r, {{0}} - {{1}} AS gap FROM p GROUP BY r),
        c AS (SELECT count(*) AS replicates, count(*) FILTER (WHERE gap <= seen + 1e-14 * abs(seen)) AS lower,
              count(*) FILTER (WHERE gap >= seen - 1e-14 * abs(seen)) AS upper FROM g, o)"""


@query(
    "t6_permutation_test",
    PERMUTED_SQL.format("sum(x * f) / sum(f)", "sum(x * (1 - f)) / sum(1 - f)", "", "", "perm")
    + """ SELECT round(seen, 6) AS observed, replicates, lower, upper,
               round(least(1.0, 2 * (least(lower, upper) + 1) / (replicates + 1)::DOUBLE), 6) AS p FROM c, o""",
)
def t6(t: Tables):
    out = resampling.permutation_test(t.supplier, "s_suppkey", "s_acctbal", F.col("s_nationkey") < 12, REPLICATES, "perm")
    return out.withColumns({"observed": F.round("observed", 6), "p": F.round("p", 6)})


OF_EVENTS = {"FROM supplier": "FROM events", "s_suppkey": "event_id", "s_acctbal": "value", "s_nationkey < 12": "event_type = 'click'"}


def _of_events(sql: str) -> str:
    """The same check over the events: clicks against the rest."""
    for old, new in OF_EVENTS.items():
        sql = sql.replace(old, new)
    return sql


@query(
    "t6b_permutation_test_of_events",
    _of_events(PERMUTED_SQL.format("sum(x * f) / sum(f)", "sum(x * (1 - f)) / sum(1 - f)", "", "", "perm"))
    + """ SELECT round(seen, 6) AS observed, replicates, lower, upper,
               round(least(1.0, 2 * (least(lower, upper) + 1) / (replicates + 1)::DOUBLE), 6) AS p FROM c, o""",
)
def t6b(t: Tables):
    out = resampling.permutation_test(t.events, "event_id", "value", F.col("event_type") == "click", REPLICATES, "perm")
    return out.withColumns({"observed": F.round("observed", 6), "p": F.round("p", 6)})


def rich_share(value, weight):
    """A statistic of the user's own: the weighted share of balances above 5000."""
    return F.sum((value > 5000).cast("int") * weight) / F.sum(weight)


@query(
    "x1_user_statistic_in_a_test",
    PERMUTED_SQL.format("sum((x > 5000)::INTEGER * f) / sum(f)", "sum((x > 5000)::INTEGER * (1 - f)) / sum(1 - f)", "", "", "own")
    + """ SELECT round(seen, 6) AS observed, replicates, lower, upper,
               round(least(1.0, 2 * (least(lower, upper) + 1) / (replicates + 1)::DOUBLE), 6) AS p FROM c, o""",
)
def x1(t: Tables):
    out = resampling.permutation_test(
        t.supplier, "s_suppkey", "s_acctbal", F.col("s_nationkey") < 12, REPLICATES, "own", statistic=rich_share
    )
    return out.withColumns({"observed": F.round("observed", 6), "p": F.round("p", 6)})


def _ordered_sql(statistic: str, salt: str) -> str:
    """PERMUTED_SQL for a statistic of a sorted list."""
    return PERMUTED_SQL.format(
        f"{statistic.format('list(x ORDER BY x) FILTER (f = 1)')}", f"{statistic.format('list(x ORDER BY x) FILTER (f = 0)')}", "", "", salt
    ) + """ SELECT round(seen, 6) AS observed, replicates, lower, upper,
               round(least(1.0, 2 * (least(lower, upper) + 1) / (replicates + 1)::DOUBLE), 6) AS p FROM c, o"""


def _user_test(t: Tables, aggregator, salt: str) -> DataFrame:
    poor = F.col("s_nationkey") < 12
    out = resampling.permutation_test(t.supplier, "s_suppkey", "s_acctbal", poor, REPLICATES, salt, statistic=aggregator)
    return out.withColumns({"observed": F.round("observed", 6), "p": F.round("p", 6)})


@query("x1b_median_in_a_test", _ordered_sql("list_aggregate({}, 'quantile_cont', 0.5)", "median"))
def x1b(t: Tables):
    return _user_test(t, aggregators.median(), "median")


TRIMMED = "list_avg({0}[1 + floor(0.1 * len({0}))::BIGINT : len({0}) - floor(0.1 * len({0}))::BIGINT])"


@query("x1c_trimmed_mean_in_a_test", _ordered_sql(TRIMMED, "trimmed"))
def x1c(t: Tables):
    return _user_test(t, aggregators.trimmed_mean(0.1), "trimmed")


@query(
    "t7_multiple_testing",
    f"""WITH g AS (SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE AS n1, avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS m1,
              var_samp(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS v1, count(*) FILTER (WHERE l_returnflag <> 'R')::DOUBLE AS n2,
              avg(l_extendedprice) FILTER (WHERE l_returnflag <> 'R') AS m2, var_samp(l_extendedprice) FILTER (WHERE l_returnflag <> 'R') AS v2
              FROM lineitem GROUP BY l_suppkey),
        w AS (SELECT l_suppkey, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS t, pow(v1 / n1 + v2 / n2, 2) /
              (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM g WHERE v1 > 0 AND v2 > 0),
        p AS (SELECT l_suppkey, {_t_tail_sql('t', 'df')} AS p FROM w),
        r AS (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p, l_suppkey) AS k FROM p),
        a AS (SELECT l_suppkey, p, m, least(1.0, min(p * m / k) OVER (ORDER BY p DESC, l_suppkey DESC)) AS adj FROM r)
        SELECT l_suppkey, round(p, 6) AS p, round(adj, 6) AS p_adjusted, adj < 0.05 AS bh_significant,
               p < 0.05 / m AS bonferroni_significant FROM a""",
)
def t7(t: Tables):
    """One Welch test per supplier: prices of returned lines against the others."""
    returned = F.col("l_returnflag") == "R"
    tests = inference.welch(t.lineitem, "l_extendedprice", returned, ~returned, by=["l_suppkey"]).where("p is not null")
    out = inference.adjust_p(tests.select("l_suppkey", "p"), "l_suppkey", "p")
    return out.withColumns({"p": F.round("p", 6), "p_adjusted": F.round("p_adjusted", 6)})


@query(
    "t8_feature_screen",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature, count(*) AS n, round(corr({a}, l_extendedprice), 6) AS r FROM lineitem"
        for a in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    ),
)
def t8(t: Tables):
    out = inference.screen_features(t.lineitem, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice")
    return out.select("feature", "n", F.round("r", 6).alias("r"))


@query(
    "t8b_feature_screen_p_values",
    "WITH r AS ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, count(*)::DOUBLE AS n, corr({a}, l_extendedprice) AS r FROM lineitem"
        for a in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    )
    + f"""), s AS (SELECT feature, r * sqrt((n - 2) / (1 - r * r)) AS t, n - 2 AS df FROM r),
        p AS (SELECT feature, {_t_tail_sql('t', 'df')} AS p FROM s)
        SELECT feature, round(p, 8) AS p, round(least(1.0, min(p * 4 / k) OVER (ORDER BY p DESC)), 8) AS p_adjusted,
               p < 0.05 / 4 AS bonferroni_significant
        FROM (SELECT *, row_number() OVER (ORDER BY p) AS k FROM p)""",
)
def t8b(t: Tables):
    out = inference.screen_features(t.lineitem, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice")
    return out.select(
        "feature", F.round("p", 8).alias("p"), F.round("p_adjusted", 8).alias("p_adjusted"), "bonferroni_significant"
    )


KS_SQL = """WITH v AS (SELECT l_extendedprice AS v, count(*) FILTER (WHERE l_returnflag = 'A') AS c1,
    count(*) FILTER (WHERE l_returnflag = 'R') AS c2 FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY v),
    w AS (SELECT sum(c1) OVER (ORDER BY v) / (SELECT sum(c1) FROM v)::DOUBLE AS f1,
    sum(c2) OVER (ORDER BY v) / (SELECT sum(c2) FROM v)::DOUBLE AS f2 FROM v)"""


@query(
    "t9_kolmogorov_smirnov",
    KS_SQL + """ SELECT (SELECT sum(c1)::BIGINT FROM v) AS n1, (SELECT sum(c2)::BIGINT FROM v) AS n2,
                 round(max(abs(f1 - f2)), 8) AS ks FROM w""",
)
def t9(t: Tables):
    out = inference.ks_two_sample(t.lineitem, "l_extendedprice", F.col("l_returnflag") == "A", F.col("l_returnflag") == "R")
    return out.select("n1", "n2", F.round("ks", 8).alias("ks"))


@query(
    "t9b_kolmogorov_smirnov_p_value",
    KS_SQL
    + """, c AS (SELECT sum(c1)::DOUBLE AS n1, sum(c2)::DOUBLE AS n2, (SELECT max(abs(f1 - f2)) FROM w) AS d FROM v),
         l AS (SELECT (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * d AS lam FROM c)
         SELECT round(least(greatest(2 * (SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2 * k * k * lam * lam))
                FROM (SELECT unnest(range(1, 101)) AS k)), 0), 1), 8) AS p FROM l""",
)
def t9b(t: Tables):
    sides = F.col("l_returnflag") == "A", F.col("l_returnflag") == "R"
    return inference.ks_two_sample(t.lineitem, "l_extendedprice", *sides, exact_rows=0).select(F.round("p", 8).alias("p"))


@query(
    "t9c_exact_kolmogorov_smirnov",
    """WITH a AS (SELECT s_acctbal AS v, s_nationkey % 5 AS region, (s_nationkey < 12)::INTEGER AS f FROM supplier WHERE s_acctbal IS NOT NULL),
        c AS (SELECT region, v, sum(f) AS c1, sum(1 - f) AS c2 FROM a GROUP BY region, v),
        n AS (SELECT region, sum(c1)::BIGINT AS n1, sum(c2)::BIGINT AS n2 FROM c GROUP BY region),
        w AS (SELECT region, n1, n2, abs(sum(c1) OVER o * n2 - sum(c2) OVER o * n1) AS far FROM c JOIN n USING (region)
              WINDOW o AS (PARTITION BY region ORDER BY v)),
        d AS (SELECT region, n1, n2, max(far)::DOUBLE AS far FROM w WHERE n1 > 0 AND n2 > 0 GROUP BY region, n1, n2),
        q AS (SELECT region, n1, n2, far, list_reduce(
                list_concat([list_transform(range(n1 + 1), lambda i: 0::DOUBLE)], list_transform(range(1, n1 + n2 + 1), lambda s: [s::DOUBLE])),
                lambda h, e: list_transform(range(n1 + 1), lambda i:
                    CASE WHEN e[1] - i < 0 OR e[1] - i > n2 THEN 0::DOUBLE WHEN abs(i * n2 - (e[1] - i) * n1) >= far THEN 1::DOUBLE
                         ELSE (CASE WHEN i > 0 THEN h[i] * i ELSE 0 END + h[i + 1] * (e[1] - i)) / e[1] END)) AS h FROM d)
        SELECT region, n1, n2, round(far / (n1 * n2), 8) AS ks, round(h[n1 + 1], 8) AS p FROM q""",
)
def t9c(t: Tables):
    """One exact test per group of nations: balances of some nations against the others."""
    df = t.supplier.withColumn("region", F.col("s_nationkey") % 5)
    some = F.col("s_nationkey") < 12
    out = inference.ks_two_sample(df, "s_acctbal", some, ~some, ["region"]).where("ks is not null")
    return out.select("region", "n1", "n2", F.round("ks", 8).alias("ks"), F.round("p", 8).alias("p"))


def _psi_sql(table: str, value: str, base: str, new: str, bins: int = 10) -> str:
    edges = ", ".join(f"quantile_cont({value}, {i / bins})" for i in range(bins + 1))
    return f"""SELECT sum((n - b) * ln(n / b)) FROM (
        SELECT i, greatest(coalesce(max(cb), 0) / max(tb)::DOUBLE, 1e-6) AS b, greatest(coalesce(max(cn), 0) / max(tn)::DOUBLE, 1e-6) AS n
        FROM (SELECT unnest(range({bins})) AS i), (SELECT count(*) FILTER (WHERE {base}) AS tb, count(*) FILTER (WHERE {new}) AS tn FROM {table})
        LEFT JOIN (SELECT bin, count(*) FILTER (WHERE isb) AS cb, count(*) FILTER (WHERE isn) AS cn FROM (
            SELECT {base} AS isb, {new} AS isn, CASE WHEN v >= e[1] - 1e-6 AND v <= e[{bins + 1}] + 1e-6 THEN
              {" + ".join(["CAST(v >= e[1] - 1e-6 AS INTEGER)"] + [f"CAST(v >= e[{i + 1}] AS INTEGER)" for i in range(1, bins)])} - 1 END AS bin
            FROM (SELECT *, {value} AS v FROM {table} WHERE {base} OR {new}), (SELECT [{edges}] AS e FROM {table} WHERE {base}))
          GROUP BY bin) ON bin = i GROUP BY i)"""


@query(
    "t10_stability_index",
    f"""SELECT (SELECT count(*) FROM events WHERE event_type = 'click') AS n_base,
               (SELECT count(*) FROM events WHERE event_type = 'view') AS n_new,
               round(({_psi_sql('events', 'value', "event_type = 'click'", "event_type = 'view'")}), 6) AS psi""",
)
def t10(t: Tables):
    out = inference.stability_index(t.events, "value", F.col("event_type") == "click", F.col("event_type") == "view")
    return out.withColumn("psi", F.round("psi", 6))


@query(
    "t11_entropy_of_keys",
    """WITH k AS (SELECT count(*) AS k FROM customer GROUP BY c_nationkey, c_mktsegment), n AS (SELECT sum(k)::DOUBLE AS n FROM k)
       SELECT max(n)::BIGINT AS n, round(-sum(k / n * log2(k / n)), 6) AS entropy_bits,
              round(100.0 * sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) / max(n), 6) AS unique_percent, min(k) AS min_k,
              round(log2(max(n)), 6) AS ceiling_bits FROM k, n""",
)
def t11(t: Tables):
    out = inference.entropy_bits(t.customer, ["c_nationkey", "c_mktsegment"])
    return out.withColumns({c: F.round(c, 6) for c in ("entropy_bits", "unique_percent", "ceiling_bits")})


@query(
    "t12_tail_share",
    """WITH m AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
       SELECT count(*) AS rows, round(avg(CASE WHEN (value - m) / s > 1.96 THEN 1.0 ELSE 0.0 END), 6) AS observed,
              CAST(0.025 AS DOUBLE) AS expected FROM events, m""",
)
def t12(t: Tables):
    m = t.events.agg(F.struct(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))).scalar()
    z = t.events.withColumn("f", m).withColumn("z", (F.col("value") - F.col("f.m")) / F.col("f.s"))
    return inference.tail_share(z, F.col("z") > 1.96, 0.025).withColumn("observed", F.round("observed", 6))


# ---- fairness and drift ----------------------------------------------------------------------------


def scored(t: Tables):
    """Documents with a label and a score: the share of characters that aren't letters."""
    others = F.char_length(F.translate("text", string.ascii_letters, ""))
    letters = F.char_length("text") - others
    score = F.round(1.0 - letters / F.char_length("text"), 6)
    return t.documents.select("doc_id", "lang", score.alias("score")).join(t.labels, "doc_id")


SCORED_SQL = """scored AS (SELECT doc_id, lang, quality, toxic,
    round(1.0 - length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::DOUBLE / length(text), 6) AS score
    FROM documents JOIN labels USING (doc_id))"""

AUDIT_SQL = """count(*) AS rows, round(avg(c), 6) AS selection_rate,
    round(coalesce(avg(c) FILTER (WHERE quality = 1), 0), 6) AS tpr, round(coalesce(avg(c) FILTER (WHERE quality = 0), 0), 6) AS fpr,
    round(avg(quality), 6) AS base_rate"""


def _rounded_audit(df):
    return df.withColumns({c: F.round(c, 6) for c in ("selection_rate", "tpr", "fpr", "base_rate")})


@query(
    "e1_group_audit",
    f"""WITH {SCORED_SQL} SELECT lang, {AUDIT_SQL} FROM (SELECT *, CASE WHEN score <= 0.25 THEN 1.0 ELSE 0.0 END AS c
        FROM scored) GROUP BY lang""",
)
def e1(t: Tables):
    return _rounded_audit(fairness.audit(scored(t), "lang", "quality", F.col("score") <= 0.25))


@query(
    "e2_equal_opportunity",
    f"""WITH {SCORED_SQL}, s AS (SELECT *, -score AS s FROM scored),
        h AS (SELECT lang, quantile_cont(s, 0.57) AS th FROM s WHERE quality = 1 GROUP BY lang)
        SELECT lang, round(max(th), 6) AS threshold, {AUDIT_SQL} FROM (SELECT s.*, th, CASE WHEN s >= th THEN 1.0 ELSE 0.0 END AS c
        FROM s LEFT JOIN h USING (lang)) GROUP BY lang""",
)
def e2(t: Tables):
    df = written(scored(t).withColumn("s", -F.col("score")), "scores")
    out = fairness.equal_opportunity(df, "lang", "quality", "s", 0.43)
    return _rounded_audit(out).withColumn("threshold", F.round("threshold", 6))


def _drift_row(column: str) -> str:
    base, new = "l_returnflag = 'A'", "l_returnflag = 'N' AND l_quantity > 10"
    return f"""SELECT '{column}' AS column_name, round((SELECT avg({column}) FROM lineitem WHERE {base}), 4) AS base_mean,
      round((SELECT avg({column}) FROM lineitem WHERE {new}), 4) AS new_mean,
      round((WITH v AS (SELECT {column} AS v, count(*) FILTER (WHERE {base}) AS c1, count(*) FILTER (WHERE {new}) AS c2
         FROM lineitem WHERE ({base}) OR ({new}) GROUP BY v),
         w AS (SELECT sum(c1) OVER (ORDER BY v) / (SELECT sum(c1) FROM v)::DOUBLE - sum(c2) OVER (ORDER BY v) /
         (SELECT sum(c2) FROM v)::DOUBLE AS d FROM v) SELECT max(abs(d)) FROM w), 6) AS ks,
      round(({_psi_sql('lineitem', column, base, f'({new})')}), 6) AS psi"""


@query("e3_drift_report", " UNION ALL ".join(_drift_row(c) for c in ("l_quantity", "l_extendedprice")))
def e3(t: Tables):
    base = F.col("l_returnflag") == "A"
    new = (F.col("l_returnflag") == "N") & (F.col("l_quantity") > 10)
    out = inference.drift_report(t.lineitem, ["l_quantity", "l_extendedprice"], base, new)
    digits = {"base_mean": 4, "new_mean": 4, "ks": 6, "psi": 6}
    return out.select("column_name", *[F.round(c, k).alias(c) for c, k in digits.items()])
