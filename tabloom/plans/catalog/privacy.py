"""Privacy operators."""

from pyspark.sql import functions as F

from ...operators import inference, privacy
from ..registry import Tables, md5_sql, open_uniform_sql, query, uniform_sql

PEOPLE_SQL = """people AS (SELECT o_orderkey, c_nationkey, c_mktsegment, o_orderpriority, o_orderstatus,
    CAST(month(o_orderdate) AS INTEGER) AS o_month, CAST(year(o_orderdate) AS INTEGER) AS o_year
    FROM orders JOIN customer ON o_custkey = c_custkey)"""


def people(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey", "c_nationkey", "c_mktsegment", "o_orderpriority", "o_orderstatus",
        F.month("o_orderdate").alias("o_month"), F.year("o_orderdate").alias("o_year"),
    )


KEY_SETS = {
    "fine": ["c_nationkey", "c_mktsegment", "o_orderpriority", "o_month", "o_year"],
    "middle": ["c_nationkey", "c_mktsegment", "o_orderpriority", "o_month"],
    "coarse": ["c_nationkey", "c_mktsegment"],
}


@query(
    "v1_reidentification_risk",
    f"WITH {PEOPLE_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS key_set, sum(k)::BIGINT AS rows, round(100.0 * count(*) FILTER (WHERE k = 1) / sum(k), 6)
        AS unique_percent, min(k) AS min_k FROM (SELECT count(*) AS k FROM people GROUP BY {", ".join(keys)})"""
        for name, keys in KEY_SETS.items()
    ),
)
def v1(t: Tables):
    out = privacy.reidentification_risk(people(t), KEY_SETS)
    return out.withColumn("unique_percent", F.round("unique_percent", 6))


K_SQL = """SELECT '{0}' AS stage, sum(k)::BIGINT AS rows, round(100.0 * coalesce(sum(k) FILTER (WHERE k < 5), 0) / sum(k), 6)
           AS below_k_percent, min(k) AS min_k FROM (SELECT count(*) AS k FROM {1} GROUP BY {2})"""


@query(
    "v2_k_anonymity",
    f"""WITH {PEOPLE_SQL}, g AS (SELECT * REPLACE (CAST(floor(o_month / 6.0) * 6 AS BIGINT) AS o_month) FROM people) """
    + K_SQL.format("before", "people", ", ".join(KEY_SETS["fine"])) + " UNION ALL "
    + K_SQL.format("after", "g", "c_nationkey, c_mktsegment, o_month"),
)
def v2(t: Tables):
    df = people(t)
    coarse = privacy.generalise(df, {"o_month": 6}, ["o_year", "o_orderpriority"])
    before = privacy.k_anonymity(df, KEY_SETS["fine"]).withColumn("stage", F.lit("before"))
    after = privacy.k_anonymity(coarse, ["c_nationkey", "c_mktsegment", "o_month"]).withColumn("stage", F.lit("after"))
    return before.unionByName(after).withColumn("below_k_percent", F.round("below_k_percent", 6))


@query(
    "v2b_suppressed_release",
    f"""WITH {PEOPLE_SQL} SELECT o_orderkey FROM (SELECT o_orderkey, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment,
        o_orderpriority, o_month) AS k FROM people) WHERE k >= 3""",
)
def v2b(t: Tables):
    return privacy.suppress_small_groups(people(t), KEY_SETS["middle"], 3).select("o_orderkey")


@query(
    "v3_l_diversity",
    f"""WITH {PEOPLE_SQL} SELECT count(*) AS groups, round(100.0 * avg(CASE WHEN d >= 2 THEN 1.0 ELSE 0.0 END), 6)
        AS diverse_percent, min(d) AS min_distinct FROM (SELECT count(DISTINCT o_orderstatus) AS d FROM people
        GROUP BY c_nationkey, c_mktsegment, o_orderpriority, o_month)""",
)
def v3(t: Tables):
    out = privacy.l_diversity(people(t), KEY_SETS["middle"], "o_orderstatus")
    return out.withColumn("diverse_percent", F.round("diverse_percent", 6))


@query(
    "v4_entropy_ladder",
    f"WITH {PEOPLE_SQL} "
    + " UNION ALL ".join(
        f"""SELECT {i} AS step, '{name}' AS key_set, max(n)::BIGINT AS n, round(-sum(k / n * log2(k / n)), 6) AS entropy_bits,
        round(100.0 * count(*) FILTER (WHERE k = 1) / max(n), 6) AS unique_percent, min(k) AS min_k,
        round(log2(max(n)), 6) AS ceiling_bits FROM (SELECT count(*) AS k FROM people GROUP BY {", ".join(keys)}),
        (SELECT count(*)::DOUBLE AS n FROM people)"""
        for i, (name, keys) in enumerate(KEY_SETS.items())
    ),
)
def v4(t: Tables):
    out = inference.entropy_ladder(people(t), KEY_SETS)
    return out.withColumns({c: F.round(c, 6) for c in ("entropy_bits", "unique_percent", "ceiling_bits")})


def _laplace_sql(u: str, scale: str) -> str:
    return f"(-({scale}) * sign({u} - 0.5) * ln(1 - 2 * abs({u} - 0.5)))"


@query(
    "v5_noisy_counts",
    f"""SELECT n_name, sum(f)::BIGINT AS true, round(sum(f) + {_laplace_sql(open_uniform_sql('dp', 'n_name'), '2.0')}, 6) AS noisy
        FROM (SELECT n_name, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS f FROM customer
              JOIN nation ON c_nationkey = n_nationkey) GROUP BY n_name""",
)
def v5(t: Tables):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rich = (F.col("c_acctbal") > 5000).cast("int")
    out = privacy.noisy_counts(rows, ["n_name"], rich, epsilon=0.5, test_salt="dp")
    return out.withColumn("noisy", F.round("noisy", 6))


@query(
    "v5b_geometric_counts",
    f"""SELECT event_type, count(*) AS true, count(*) + CAST(floor(ln({open_uniform_sql('geoa', 'event_type')}) / -0.5) AS BIGINT)
        - CAST(floor(ln({open_uniform_sql('geobb', 'event_type')}) / -0.5) AS BIGINT) AS noisy FROM events GROUP BY event_type""",
)
def v5b(t: Tables):
    return privacy.geometric_counts(t.events, ["event_type"], epsilon=0.5, test_salt="geo")


@query("v5c_noisy_counts_secure")
def v5c(t: Tables):
    return privacy.noisy_counts(t.events, ["event_type"], F.lit(1), epsilon=1.0).drop("true")


EPSILONS = (0.1, 0.5, 1.0, 5.0)


@query(
    "v6_noise_error_curve",
    f"""WITH g AS (SELECT n_name, count(*) AS c FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
        d AS (SELECT epsilon, c, {open_uniform_sql('err', 'n_name', 'epsilon', 'r')} AS u FROM g,
         (SELECT unnest([0.1, 0.5, 1.0, 5.0]::DOUBLE[]) AS epsilon), (SELECT unnest(range(1, 201)) AS r)),
        e AS (SELECT epsilon, c, abs(greatest(round(c + {_laplace_sql('u', '1.0')} / epsilon), 0) - c) AS err FROM d)
        SELECT epsilon, count(*) AS draws, round(avg(err), 6) AS mean_abs_error, round(avg(err / c), 6) AS mean_rel_error
        FROM e GROUP BY epsilon""",
)
def v6(t: Tables):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    out = privacy.noise_error_curve(rows, ["n_name"], EPSILONS, 200, "err")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_abs_error", "mean_rel_error")})


@query(
    "v7_randomised_response",
    f"""WITH r AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS y, CASE WHEN {uniform_sql('rr-1', 'o_orderkey')} < 0.5
        THEN CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END WHEN {uniform_sql('rr-2', 'o_orderkey')} < 0.5 THEN 1.0 ELSE 0.0 END AS a
        FROM orders)
        SELECT count(*) AS rows, round(avg(y), 6) AS true_rate, round(avg(a), 6) AS observed_rate,
               round(2 * avg(a) - 0.5, 6) AS estimate, round(ln(3), 6) AS epsilon FROM r""",
)
def v7(t: Tables):
    out = privacy.randomised_response(t.orders, "o_orderkey", F.col("o_orderstatus") == "F", "rr")
    return out.withColumns({c: F.round(c, 6) for c in ("true_rate", "observed_rate", "estimate", "epsilon")})


def _resample_sql(i: int, columns: str) -> str:
    return f"""i{i} AS (SELECT row_number() OVER (ORDER BY {md5_sql(f'syn-{i}-index', 'c_custkey')}) - 1 AS i, {columns} FROM customer),
    d{i} AS (SELECT draw, {columns} FROM (SELECT row_number() OVER (ORDER BY {md5_sql(f'syn-{i}-draw', 'c_custkey')}) - 1 AS draw
             FROM customer) d JOIN i{i} ON i{i}.i = CAST(floor({uniform_sql(f'syn-{i}', 'draw')} *
             (SELECT count(*) FROM customer)) AS BIGINT))"""


@query(
    "v9_independent_synthesis",
    f"""WITH {_resample_sql(0, 'c_nationkey, c_mktsegment')}, {_resample_sql(1, 'c_acctbal')}
        SELECT draw, c_nationkey, c_mktsegment, c_acctbal FROM d0 JOIN d1 USING (draw)""",
)
def v9(t: Tables):
    return privacy.synthesise_independent(t.customer, "c_custkey", [["c_nationkey", "c_mktsegment"], ["c_acctbal"]], "syn")
