"""Joins, groupings, windows, sorts, samples and set operations."""

from pyspark.sql import functions as F

from ...operators import joins, sampling, sketches
from ...operators import relational as rel
from ...session import written
from ..registry import Tables, md5_sql, query, uniform_sql

# ---- joins ------------------------------------------------------------------------------


@query(
    "j1_left_join_keeps_unmatched",
    """SELECT c_custkey, n_name FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) ON c_nationkey = n_nationkey""",
)
def j1(t: Tables):
    dim = t.nation.where("n_regionkey < 4").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.dimension_join(t.customer, dim, ["c_nationkey"], "left").select("c_custkey", "n_name")


@query(
    "j2_inner_join",
    """SELECT c_custkey, n_name FROM customer
       JOIN (SELECT * FROM nation WHERE n_regionkey < 4) ON c_nationkey = n_nationkey""",
)
def j2(t: Tables):
    dim = t.nation.where("n_regionkey < 4").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.dimension_join(t.customer, dim, ["c_nationkey"], "inner").select("c_custkey", "n_name")


@query(
    "j3_validated_many_to_one",
    """SELECT o_orderpriority, count(*) AS n, true AS rejected
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderpriority""",
)
def j3(t: Tables):
    dim = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    good = joins.dimension_join(t.orders, dim, ["o_custkey"], "inner", validate="many_to_one")
    try:
        joins.check_relationship(t.orders, t.orders, ["o_custkey"], "many_to_one")
        rejected = False
    except ValueError:
        rejected = True
    return good.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.lit(rejected).alias("rejected"))


@query(
    "j4_unmatched_count",
    """SELECT count(*) AS unmatched FROM customer
       WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 4)""",
)
def j4(t: Tables):
    dim = t.nation.where("n_regionkey < 4").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.unmatched(t.customer, dim, ["c_nationkey"]).agg(F.count("*").alias("unmatched"))


@query(
    "j5_semi_join_keeps_duplicates",
    """SELECT l_orderkey, l_linenumber FROM lineitem
       WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)""",
)
def j5(t: Tables):
    wanted = t.part.where("p_size > 40").select(F.col("p_partkey").alias("l_partkey"))
    return joins.common_rows(t.lineitem, wanted, ["l_partkey"]).select("l_orderkey", "l_linenumber")


@query(
    "j6_group_statistics_lookup",
    """WITH g AS (SELECT l_partkey, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s
                 FROM lineitem GROUP BY l_partkey)
       SELECT l_linenumber, count(*) AS n, count(s) AS scored,
              round(sum(CASE WHEN s > 0 THEN (l_extendedprice - m) / s END), 4) + 0.0 AS z_sum
       FROM lineitem JOIN g USING (l_partkey) GROUP BY l_linenumber""",
)
def j6(t: Tables):
    stats = t.lineitem.groupBy("l_partkey").agg(
        F.avg("l_extendedprice").alias("m"), F.stddev_samp("l_extendedprice").alias("s")
    )
    rows = joins.attach_group_stats(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), ["l_partkey"], stats
    )
    z = F.when(F.col("s") > 0, (F.col("l_extendedprice") - F.col("m")) / F.col("s"))
    return rows.groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.count("s").alias("scored"), (F.round(F.sum(z), 4) + 0.0).alias("z_sum")
    )


@query(
    "j7_star_join",
    """SELECT r_name, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, o_orderpriority""",
)
def j7(t: Tables):
    star = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        star.groupBy("r_name", "o_orderpriority")
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        .orderBy(F.desc("total"))
    )


@query(
    "j8_grid_against_rows",
    """SELECT g.level, count(*) AS n, sum(CASE WHEN l_discount >= g.level THEN 1 ELSE 0 END)::BIGINT AS at_least
       FROM lineitem, (SELECT unnest([0.0, 0.025, 0.05, 0.075]::DOUBLE[]) AS level) AS g GROUP BY g.level""",
)
def j8(t: Tables):
    # the rows are counted per distinct value first, so the grid meets those few values
    counted = t.lineitem.groupBy("l_discount").agg(F.count("*").alias("m"))
    grid = F.explode(F.array(*[F.lit(x) for x in (0.0, 0.025, 0.05, 0.075)])).alias("level")
    spread = counted.select("l_discount", "m", grid)
    hit = F.when(F.col("l_discount") >= F.col("level"), F.col("m")).otherwise(0)
    return spread.groupBy("level").agg(F.sum("m").alias("n"), F.sum(hit).alias("at_least"))


@query(
    "j1b_null_safe_left_join",
    """WITH f AS (SELECT CASE WHEN c_nationkey < 20 THEN c_nationkey END AS k FROM customer),
            d AS (SELECT CASE WHEN n_nationkey < 20 THEN n_nationkey END AS k, count(*) AS nations
                  FROM nation GROUP BY 1)
       SELECT f.k, max(nations) AS nations, count(*) AS n
       FROM f LEFT JOIN d ON f.k IS NOT DISTINCT FROM d.k GROUP BY f.k""",
)
def j1b(t: Tables):
    facts = t.customer.select(F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")).alias("k"))
    dim = t.nation.groupBy(F.when(F.col("n_nationkey") < 20, F.col("n_nationkey")).alias("k"))
    dim = dim.agg(F.count("*").alias("nations"))
    joined = joins.dimension_join(facts, dim, ["k"], "left", null_safe=True)
    return joined.groupBy("k").agg(F.max("nations").alias("nations"), F.count("*").alias("n"))


# ---- aggregates ----------------------------------------------------------------------------


@query(
    "a1_named_group_summary",
    """SELECT l_returnflag, round_even(avg(l_extendedprice), 3) AS mean,
              round_even(quantile_cont(l_extendedprice, 0.5), 3) AS median,
              count(l_extendedprice) AS n, round_even(max(l_extendedprice), 3) AS peak
       FROM lineitem GROUP BY l_returnflag""",
)
def a1(t: Tables):
    return rel.summary_by_group(t.lineitem, ["l_returnflag"], "l_extendedprice")


@query(
    "a2_filter_group_aggregate_sort",
    """SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 3) AS mean_qty, count(*) AS n,
              round(max(l_extendedprice), 3) AS peak_price
       FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_returnflag, l_linestatus""",
)
def a2(t: Tables):
    kept = rel.keep_values(t.lineitem, "l_returnflag", ["A", "R"])
    return (
        kept.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.avg("l_quantity"), 3).alias("mean_qty"),
            F.count("*").alias("n"),
            F.round(F.max("l_extendedprice"), 3).alias("peak_price"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


@query(
    "a3b_group_mean_without_null_key",
    """SELECT nullif(l_linenumber, 7) AS k, round(avg(l_extendedprice), 4) AS mean_price, count(*) AS n
       FROM lineitem WHERE nullif(l_linenumber, 7) IS NOT NULL GROUP BY k""",
)
def a3b(t: Tables):
    keyed = t.lineitem.withColumn("k", F.nullif("l_linenumber", F.lit(7)))
    return rel.group(keyed, ["k"], drop_null_keys=True).agg(
        F.round(F.avg("l_extendedprice"), 4).alias("mean_price"), F.count("*").alias("n")
    )


@query(
    "a3_group_mean_with_null_key",
    """SELECT nullif(l_linenumber, 7) AS k, round(avg(l_extendedprice), 4) AS mean_price, count(*) AS n
       FROM lineitem GROUP BY k""",
)
def a3(t: Tables):
    keyed = t.lineitem.withColumn("k", F.nullif("l_linenumber", F.lit(7)))
    return (
        keyed.groupBy("k")
        .agg(F.round(F.avg("l_extendedprice"), 4).alias("mean_price"), F.count("*").alias("n"))
        .orderBy("k")
    )


@query(
    "a4_global_aggregate_of_one_value",
    "SELECT round(avg(value), 6) AS mean_value, count(*) AS n FROM events WHERE event_type = 'click'",
)
def a4(t: Tables):
    one = t.events.where(F.col("event_type") == "click")
    return one.agg(F.round(F.avg("value"), 6).alias("mean_value"), F.count("*").alias("n"))


@query(
    "a5_group_mean_and_deviation",
    """SELECT p_type, round(avg(p_size), 6) AS size_mean, round(stddev_samp(p_size), 6) AS size_std,
              round(avg(p_retailprice), 6) AS price_mean, round(stddev_samp(p_retailprice), 6) AS price_std
       FROM part GROUP BY p_type""",
)
def a5(t: Tables):
    return t.part.groupBy("p_type").agg(
        F.round(F.avg("p_size"), 6).alias("size_mean"),
        F.round(F.stddev_samp("p_size"), 6).alias("size_std"),
        F.round(F.avg("p_retailprice"), 6).alias("price_mean"),
        F.round(F.stddev_samp("p_retailprice"), 6).alias("price_std"),
    )


@query(
    "a6_summary_by_method",
    """SELECT 'mean' AS method, round_even(avg(o_totalprice), 2) AS value FROM orders
       UNION ALL SELECT 'median', round_even(quantile_cont(o_totalprice, 0.5), 2) FROM orders""",
)
def a6(t: Tables):
    parts = [rel.summarise(t.orders, "o_totalprice", m).select(F.lit(m).alias("method"), "value") for m in ("mean", "median")]
    return parts[0].unionByName(parts[1])


SPLIT = (
    r"regexp_split_to_array(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')"
)


@query(
    "a7_top_words",
    f"""SELECT word, count(*) AS n FROM (SELECT unnest({SPLIT}) AS word FROM documents)
        WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 20""",
)
def a7(t: Tables):
    return rel.top_k(rel.word_counts(t.documents, "text"), 20, F.desc("n"), F.asc("word"))


@query(
    "a8_percent_per_band",
    """SELECT r.rank, r.label, count(b.label) AS n,
              round(count(b.label) * 100.0 / (SELECT count(*) FROM part WHERE p_size > 0 AND p_size <= 50), 1) AS percent
       FROM (VALUES (0, 'small'), (1, 'middle'), (2, 'large'), (3, 'huge')) AS r(rank, label)
       LEFT JOIN (SELECT CASE WHEN p_size > 0 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 25
                  THEN 'middle' WHEN p_size > 25 AND p_size <= 40 THEN 'large' WHEN p_size > 40 AND p_size <= 50
                  THEN 'huge' END AS label FROM part) AS b ON b.label = r.label GROUP BY r.rank, r.label""",
)
def a8(t: Tables):
    from ...functions.scalars import band

    labels = ["small", "middle", "large", "huge"]
    return rel.shares(t.part, band("p_size", [0, 10, 25, 40, 50], labels), labels)


@query(
    "a9_distinct_counts",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
       FROM lineitem GROUP BY l_returnflag""",
)
def a9(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


# The sketch queries answer whether an estimate from merged slices lies within its stated error of the exact answer.


def line_sketches(t: Tables):
    """A sketch per month and return flag, stored."""
    month = F.date_trunc("month", "l_shipdate").alias("month")
    lines = t.lineitem.select("*", month)
    keys = {"parts": ["l_partkey"], "suppliers": ["l_suppkey"]}
    return written(sketches.sketch_table(lines, ["month", "l_returnflag"], ["l_extendedprice"], keys), "line-sketches")


@query(
    "a1b_quantiles_from_merged_sketches",
    "SELECT l_returnflag, count(l_extendedprice) AS n, true AS median_fits, true AS top_fits FROM lineitem GROUP BY l_returnflag",
)
def a1b(t: Tables):
    found = sketches.merged_quantiles(line_sketches(t), "l_extendedprice", {"median": 0.5, "top": 0.99}, ["l_returnflag"])
    both = t.lineitem.join(F.broadcast(written(found, "merged")), "l_returnflag")  # a row per return flag
    x, slack = F.col("l_extendedprice"), sketches.rank_error()

    def fits(name: str, p: float):
        below, up_to = F.avg((x < F.col(name)).cast("int")), F.avg((x <= F.col(name)).cast("int"))
        return ((below <= p + slack) & (up_to >= p - slack)).alias(f"{name}_fits")

    return both.groupBy("l_returnflag", "n").agg(fits("median", 0.5), fits("top", 0.99))


@query(
    "a9b_distinct_counts_from_merged_sketches",
    "SELECT DISTINCT l_returnflag, true AS parts_fit, true AS suppliers_fit FROM lineitem",
)
def a9b(t: Tables):
    found = sketches.merged_distinct(line_sketches(t), ["parts", "suppliers"], ["l_returnflag"])
    exact = a9(t).withColumnsRenamed({"parts": "exact_parts", "suppliers": "exact_suppliers"})

    def fits(name: str):
        return F.abs(F.col(name) - F.col(f"exact_{name}")) <= sketches.distinct_error() * F.col(f"exact_{name}")

    return found.join(exact, "l_returnflag").select(
        "l_returnflag", fits("parts").alias("parts_fit"), fits("suppliers").alias("suppliers_fit")
    )


@query("j4b_unmatched_keys_from_sketches", "SELECT true AS left_fits, true AS unmatched_fits")
def j4b(t: Tables):
    """Parts that were returned and never delivered otherwise, from the sketches of either side."""
    stored = line_sketches(t)
    returned = F.col("l_returnflag") == "R"
    found = sketches.unmatched_keys(stored.where(returned), stored.where(~returned), "parts")
    keys = t.lineitem.groupBy("l_partkey").agg(F.max(returned).alias("a"), F.max(~returned).alias("b"))
    exact = keys.agg(F.count_if("a").alias("l"), F.count_if(F.col("a") & ~F.col("b")).alias("u"), F.count("*").alias("union"))
    slack = sketches.theta_error() * F.col("union")
    both = found.join(F.broadcast(exact))  # one row each
    return both.select(
        (F.abs(F.col("left_keys") - F.col("l")) <= slack).alias("left_fits"),
        (F.abs(F.col("unmatched") - F.col("u")) <= slack).alias("unmatched_fits"),
    )


@query(
    "a10_null_count",
    """SELECT count(*) AS rows, sum(CASE WHEN n_name IS NULL THEN 1 ELSE 0 END)::BIGINT AS nulls
       FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) ON c_nationkey = n_nationkey""",
)
def a10(t: Tables):
    dim = t.nation.where("n_regionkey < 4").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rel.null_report(t.customer.join(dim, "c_nationkey", "left"))


@query(
    "a11_share_meeting_a_condition",
    """SELECT event_type, round(avg(CASE WHEN value > 20 THEN 1.0 ELSE 0.0 END), 6) AS share,
              sum(CASE WHEN value > 20 THEN 1 ELSE 0 END)::BIGINT AS n FROM events GROUP BY event_type""",
)
def a11(t: Tables):
    high = F.col("value") > 20
    return t.events.groupBy("event_type").agg(
        F.round(F.avg(high.cast("double")), 6).alias("share"), F.count_if(high).alias("n")
    )


@query(
    "a12_sum_of_flag",
    """SELECT n_name, sum(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END)::BIGINT AS rich
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def a12(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.sum((F.col("c_acctbal") > 5000).cast("int")).alias("rich"))


@query(
    "a13_pools_per_group",
    """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1
                  AS pos FROM events)
       SELECT event_type, pos // 500 AS chunk, count(*) AS n, string_agg(CAST(value AS VARCHAR), '|' ORDER BY value)
              AS pool FROM r GROUP BY event_type, chunk""",
)
def a13(t: Tables):
    pools = rel.group_pools(t.events, ["event_type"], "value", "event_id", chunk_rows=500)
    shown = F.array_join(F.transform("values", lambda v: v.cast("string")), "|")
    return pools.select("event_type", "chunk", "n", shown.alias("pool"))


@query(
    "a14_key_of_largest",
    """SELECT o_custkey AS key, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY o_custkey
       ORDER BY value DESC, key LIMIT 1""",
)
def a14(t: Tables):
    spent = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return rel.largest_key(spent, "o_custkey", "total")


@query(
    "a15_most_common_class",
    "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 1",
)
def a15(t: Tables):
    return rel.most_common(t.documents, "source")


@query(
    "a16_pivot_of_means",
    """SELECT l_returnflag, round(avg(CASE WHEN l_linestatus = 'F' THEN l_quantity END), 6) AS F,
              round(avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 6) AS O
       FROM lineitem GROUP BY l_returnflag""",
)
def a16(t: Tables):
    wide = rel.pivot_mean(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O"], "l_quantity")
    return wide.select("l_returnflag", F.round("F", 6).alias("F"), F.round("O", 6).alias("O"))


@query(
    "a17_means_in_given_order",
    """SELECT r.rank, r.l_returnflag, round(avg(l_tax), 6) AS l_tax, round(avg(l_discount), 6) AS l_discount
       FROM (VALUES (0, 'R'), (1, 'A'), (2, 'X')) AS r(rank, l_returnflag)
       LEFT JOIN lineitem AS l ON l.l_returnflag = r.l_returnflag GROUP BY r.rank, r.l_returnflag""",
)
def a17(t: Tables):
    out = rel.means_in_order(t.lineitem, "l_returnflag", ["l_tax", "l_discount"], ["R", "A", "X"])
    return out.withColumns({c: F.round(c, 6) for c in ("l_tax", "l_discount")})


@query(
    "a18_mean_per_level",
    """SELECT CAST(l_quantity AS BIGINT) AS level, count(*) AS n, round(avg(l_extendedprice), 4) AS mean
       FROM lineitem GROUP BY level""",
)
def a18(t: Tables):
    from ...operators.distributions import profile_by_level

    out = profile_by_level(t.lineitem, F.col("l_quantity").cast("bigint"), "l_extendedprice")
    return out.withColumn("mean", F.round("mean", 4))


@query(
    "a19_sorted_group_means",
    """SELECT lang, round(avg(n_chars), 4) AS mean_chars FROM documents WHERE lang IN ('en', 'de', 'fr')
       GROUP BY lang""",
)
def a19(t: Tables):
    kept = rel.keep_values(t.documents, "lang", ["en", "de", "fr"])
    return kept.groupBy("lang").agg(F.round(F.avg("n_chars"), 4).alias("mean_chars")).orderBy("mean_chars")


@query(
    "a20_scalar_summary",
    """SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean,
              round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
              round(stddev_samp(l_extendedprice), 4) AS std_sample,
              round(stddev_pop(l_extendedprice), 4) AS std_population,
              round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 4) AS iqr
       FROM lineitem""",
)
def a20(t: Tables):
    out = rel.summary(t.lineitem, "l_extendedprice")
    return out.select("n", *[F.round(c, 4).alias(c) for c in ("mean", "median", "std_sample", "std_population", "iqr")])


LADDER = {
    "nation": ["c_nationkey"],
    "nation+segment": ["c_nationkey", "c_mktsegment"],
    "nation+segment+balance": ["c_nationkey", "c_mktsegment", "balance_band"],
}


@query(
    "a21_group_sizes_of_key_sets",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS key_set, sum(k)::BIGINT AS rows,
            round(100.0 * sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) / sum(k), 6) AS unique_percent, min(k) AS min_k
            FROM (SELECT count(*) AS k FROM (SELECT *, CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance_band
            FROM customer) GROUP BY {", ".join(keys)})"""
        for name, keys in LADDER.items()
    ),
)
def a21(t: Tables):
    from ...operators.privacy import reidentification_risk

    df = t.customer.withColumn("balance_band", F.floor(F.col("c_acctbal") / 1000))
    return reidentification_risk(df, LADDER).withColumn("unique_percent", F.round("unique_percent", 6))


@query(
    "a22_relative_gap",
    """WITH m AS (SELECT avg(CASE WHEN event_type = 'click' THEN value END) AS b,
                         avg(CASE WHEN event_type = 'view' THEN value END) AS o FROM events)
       SELECT round(b, 6) AS base_mean, round(o, 6) AS other_mean, round((o - b) / b * 100, 6) AS gap_percent,
              round(b / (b - b * 0.98), 6) AS exaggeration FROM m""",
)
def a22(t: Tables):
    out = rel.relative_gap(t.events, "event_type", "value", "click", "view")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


# ---- windows -----------------------------------------------------------------------------------


@query(
    "w1_above_group_median",
    """WITH m AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS med FROM lineitem GROUP BY l_returnflag)
       SELECT l_returnflag, round(max(med), 4) AS group_median, count(*) AS n,
              sum(CASE WHEN l_extendedprice > med THEN 1 ELSE 0 END)::BIGINT AS above
       FROM lineitem JOIN m USING (l_returnflag) GROUP BY l_returnflag""",
)
def w1(t: Tables):
    rows = rel.above_group_median(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"),
        "l_extendedprice", ["l_returnflag"],
    )
    return rows.groupBy("l_returnflag").agg(
        F.round(F.max("group_median"), 4).alias("group_median"),
        F.count("*").alias("n"),
        F.count_if("above").alias("above"),
    )


@query(
    "w2_group_size_per_row",
    """SELECT c_custkey, count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS k FROM customer""",
)
def w2(t: Tables):
    return rel.group_size(t.customer, ["c_nationkey", "c_mktsegment"]).select("c_custkey", "k")


DAILY_SQL = """d AS (SELECT CAST(o_orderdate AS DATE) AS bucket, sum(o_totalprice) AS total
               FROM orders GROUP BY bucket)"""


def _daily(t: Tables):
    return rel.daily_series(t.orders, "o_orderdate", total=F.sum("o_totalprice"))


@query(
    "w3_trailing_mean",
    f"""WITH {DAILY_SQL} SELECT bucket, round(CASE WHEN count(total) OVER w >= 7 THEN avg(total) OVER w END, 2)
        AS moving_mean FROM d WINDOW w AS (ORDER BY bucket ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def w3(t: Tables):
    out = rel.moving_mean(_daily(t), "bucket", "total", before=6, block=500)
    return out.select("bucket", F.round("moving_mean", 2).alias("moving_mean"))


@query(
    "w4_centred_mean",
    f"""WITH {DAILY_SQL} SELECT bucket, round(avg(total) OVER w, 2) AS moving_mean FROM d
        WINDOW w AS (ORDER BY bucket ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
)
def w4(t: Tables):
    out = rel.moving_mean(_daily(t), "bucket", "total", before=3, after=3, min_periods=1, block=500)
    return out.select("bucket", F.round("moving_mean", 2).alias("moving_mean"))


@query(
    "w5_running_mean",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seen,
              round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderkey) AS DOUBLE)
                    / row_number() OVER (ORDER BY o_orderkey), 4) AS running_mean FROM orders""",
)
def w5(t: Tables):
    # whole cents, so that the running sums are exact and no last digit depends on the order of adding
    cents = t.orders.select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    out = rel.running_mean(cents, "o_orderkey", "cents")
    return out.withColumn("running_mean", F.round("running_mean", 4))


@query(
    "w6_centred_columns",
    """SELECT p_partkey, round(p_size - (SELECT avg(p_size) FROM part), 6) AS p_size,
              round(p_retailprice - (SELECT avg(p_retailprice) FROM part), 6) AS p_retailprice FROM part""",
)
def w6(t: Tables):
    out = rel.centre(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return out.withColumns({c: F.round(c, 6) for c in ("p_size", "p_retailprice")})


@query(
    "w7_exact_sample_per_group",
    f"""SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type
        ORDER BY {md5_sql('2026', 'event_id')}) AS r FROM events) WHERE r <= 100""",
)
def w7(t: Tables):
    return sampling.sample_per_group(t.events, "event_id", 100, "2026", ["event_type"]).select("event_type", "event_id")


@query(
    "w7b_large_sample_per_group",
    f"""SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type
        ORDER BY {md5_sql('2026', 'event_id')}) AS r FROM events) WHERE r <= 1500""",
)
def w7b(t: Tables):
    return sampling.sample_per_group(t.events, "event_id", 1500, "2026", ["event_type"]).select("event_type", "event_id")


@query(
    "w8_duplicate_flag",
    """SELECT l_returnflag, sum(CASE WHEN r > 1 THEN 1 ELSE 0 END)::BIGINT AS duplicates, count(*) AS n
       FROM (SELECT l_returnflag, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem) GROUP BY l_returnflag""",
)
def w8(t: Tables):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", *order)
    marked = rel.mark_duplicates(rows, ["l_orderkey", "l_linenumber"], order)
    return marked.groupBy("l_returnflag").agg(F.count_if("is_duplicate").alias("duplicates"), F.count("*").alias("n"))


@query(
    "w9_calendar_resample",
    """SELECT b.bucket, coalesce(n, 0) AS n, coalesce(round(total, 2), 0) AS total
       FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', o_orderdate)),
             max(date_trunc('month', o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS bucket FROM orders
             ) b
       LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS bucket, count(*) AS n,
             sum(o_totalprice) AS total FROM orders GROUP BY 1) s USING (bucket)""",
)
def w9(t: Tables):
    out = rel.resample_calendar(
        t.orders, "o_orderdate", "month", {"n": 0, "total": 0.0},
        n=F.count("*"), total=F.sum("o_totalprice"),
    )
    return out.withColumn("total", F.round("total", 2))


@query(
    "g1_global_prefix_sum",
    """WITH d AS (SELECT l_extendedprice AS v, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY v)
       SELECT v, n, round(sum(q) OVER (ORDER BY v), 2) AS upto_q, (sum(n) OVER (ORDER BY v))::BIGINT - n AS before_n
       FROM d""",
)
def g1(t: Tables):
    from ...operators.ordered import cumulate

    rows = t.lineitem.withColumnRenamed("l_extendedprice", "v")
    out = cumulate(rows, "v", {"n": F.count("*"), "q": F.sum("l_quantity")}, buckets=16)
    return out.select("v", "n", F.round(F.col("q") + F.col("before_q"), 2).alias("upto_q"), "before_n")


@query(
    "g1b_global_row_number",
    """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS position FROM events""",
)
def g1b(t: Tables):
    from ...operators.ordered import row_positions

    return row_positions(t.events, "value", "event_id", by=["event_type"], buckets=16).select("event_id", "position")


# ---- sorts, samples, sets --------------------------------------------------------------------------


@query("o1_sort", "SELECT s_suppkey, s_acctbal FROM supplier")
def o1(t: Tables):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 6")
def o2(t: Tables):
    return rel.top_k(t.orders.select("o_orderkey", "o_totalprice"), 6, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("o3_first_k", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 3")
def o3(t: Tables):
    return rel.top_k(t.customer.select("c_custkey", "c_name"), 3, F.asc("c_custkey"))


@query("o4_exact_sample", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {md5_sql('42', 'o_orderkey')} LIMIT 3000")
def o4(t: Tables):
    return sampling.sample_exact(t.orders, "o_orderkey", 3000, "42").select("o_orderkey", "o_totalprice")


RESAMPLE_SQL = f"""i AS (SELECT row_number() OVER (ORDER BY {md5_sql('7-index', 'c_custkey')}) - 1 AS i, c_acctbal
                   FROM customer),
     d AS (SELECT row_number() OVER (ORDER BY {md5_sql('7-draw', 'c_custkey')}) - 1 AS draw FROM customer)"""


@query(
    "o5_sample_with_replacement",
    f"""WITH {RESAMPLE_SQL} SELECT draw, c_acctbal FROM d JOIN i
        ON i.i = CAST(floor({uniform_sql('7', 'draw')} * (SELECT count(*) FROM customer)) AS BIGINT)""",
)
def o5(t: Tables):
    return sampling.resample(t.customer, "c_custkey", ["c_acctbal"], "7")


@query("o6_reproducible_sample", f"SELECT 3000 - 3000 AS differing, count(*) AS share_rows FROM orders WHERE {uniform_sql('9', 'o_orderkey')} < 0.25")
def o6(t: Tables):
    one = sampling.sample_exact(t.orders.repartition(1), "o_orderkey", 3000, "42").select("o_orderkey")
    many = sampling.sample_exact(t.orders.repartition(17), "o_orderkey", 3000, "42").select("o_orderkey")
    differing = one.exceptAll(many).unionByName(many.exceptAll(one)).agg(F.count("*")).scalar()
    share = sampling.sample_share(t.orders, "o_orderkey", 0.25, "9")
    return share.agg(differing.alias("differing"), F.count("*").alias("share_rows"))


@query(
    "u1_union_with_index",
    """SELECT k, balance, row_number() OVER (ORDER BY balance, k) - 1 AS row_index FROM (
       SELECT c_custkey * 2 AS k, c_acctbal AS balance FROM customer UNION ALL
       SELECT s_suppkey * 2 + 1, s_acctbal FROM supplier)""",
)
def u1(t: Tables):
    a = t.customer.select((F.col("c_custkey") * 2).alias("k"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select((F.col("s_suppkey") * 2 + 1).alias("k"), F.col("s_acctbal").alias("balance"))
    return rel.union_indexed([a, b], "balance", "k")


@query("u2_distinct_records", "SELECT DISTINCT text, lang FROM documents")
def u2(t: Tables):
    return t.documents.select("text", "lang").distinct()


FIRST_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "u3_keep_first_per_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY
       l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem)
       WHERE r = 1""",
)
def u3(t: Tables):
    kept = rel.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], FIRST_ORDER)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("u4_same_rows", "SELECT count(*) AS n, true AS same, false AS differs FROM nation")
def u4(t: Tables):
    same = rel.same_rows(t.customer, t.customer.repartition(5))
    differs = rel.same_rows(t.customer, t.customer.where("c_custkey > 0"))
    return t.nation.agg(F.count("*").alias("n"), F.lit(same).alias("same"), F.lit(differs).alias("differs"))


@query(
    "u5_melt",
    """SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part
       UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""",
)
def u5(t: Tables):
    df = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return rel.melt(df, ["p_partkey"], ["p_size", "p_retailprice"])
